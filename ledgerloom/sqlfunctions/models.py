"""Model calls as scalar functions of SQL text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udf

from ..sources.io import ident_check

#: A model answers a list of distinct prompts, in their order.
Model = Callable[[list[str]], list[str]]

#: Models of this worker, by name and version; a worker that is used again has them loaded.
_LOADED: dict[tuple[str, str], Model] = {}


def loaded(name: str, version: str, load: Callable[[], Model]) -> Model:
    if (name, version) not in _LOADED:
        for old in [k for k in _LOADED if k[0] == name]:
            del _LOADED[old]
        _LOADED[name, version] = load()
    return _LOADED[name, version]


def answers(model: Model, prompts: pa.Array, at_once: int) -> pa.Array:
    """One answer per prompt; a null prompt has none, and equal prompts of a batch are asked once."""
    coded = prompts.dictionary_encode()
    asked = coded.dictionary.to_pylist()
    said: list[str | None] = []
    for a in range(0, len(asked), at_once):
        part = model(asked[a: a + at_once])
        if len(part) != len(asked[a: a + at_once]):
            raise ValueError(f"the model gave {len(part)} answers to {len(asked[a: a + at_once])} prompts")
        said += part
    return pc.take(pa.array(said, pa.string()), coded.indices)


def register_model(spark: SparkSession, name: str, load: Callable[[], Model], version: str = "1", at_once: int = 64) -> None:
    """Make ``name(prompt)`` a SQL function that asks a model, as ``SELECT name(concat(...)) FROM ...``.

    ``load`` runs once in each worker process, not once per batch or row, and again for another ``version``; the model gets
    at most ``at_once`` distinct prompts in a call. Prompts stream through in Arrow batches, so neither a partition nor a
    table is gathered. The function counts as nondeterministic, so that Spark neither repeats nor reorders its calls.
    """
    ident_check(name)

    def ask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = loaded(name, version, load)
        for prompts in batches:
            yield answers(model, prompts, at_once)

    ask.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    spark.udf.register(name, arrow_udf(ask, "string").asNondeterministic())


def create_question(spark: SparkSession, name: str, model: str, instruction: str) -> None:
    """A SQL function ``name(question)`` that asks a registered model, with fixed instructions before the question."""
    ident_check(name), ident_check(model)
    said = instruction.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(question STRING) RETURNS STRING NOT DETERMINISTIC RETURN {model}(concat('{said}', question))")


def echo() -> Model:
    """The labelled stand-in: answers with the prompt."""
    return lambda prompts: ["echo: " + p for p in prompts]
