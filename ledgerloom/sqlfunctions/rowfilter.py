"""A row filter as a SQL function: whoever writes a query calls it by name, the rule stays in one place."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..sources.io import ident_check, read_rows

#: Names of the temporary views that the functions read, and of the session variable that names the caller.
PERSONAS, MEMBERS, CALLER = "rls_personas", "rls_members", "rls_caller"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_row_filter(
    spark: SparkSession, name: str, personas: DataFrame, members: DataFrame | None = None, scope: str = "region_scope",
    admins: str = "admins", everything: str = "ALL",
) -> None:
    """Create the temporary SQL function ``name(row_value)``: whether the caller may see a row of this value.

    The caller is the session's user, or whom :func:`calling_as` names. A member of the group ``admins`` (``members`` has
    ``user_email`` and ``group_name``) and a caller whose ``scope`` is ``everything`` see each row, also one without a value;
    others see the rows of their scopes, and one unknown to ``personas`` sees nothing. A caller with several rows in
    ``personas`` has all their scopes.

    The first two tests do not depend on the row, so each is one subquery for the whole query; the third is an equality. A
    filter on the function therefore runs as a hash semi-join of the table with the caller's scopes, never as a subquery
    per row and never as a nested loop. ``personas`` and ``members`` are read when a query runs, so grants made later count.
    """
    ident_check(name), ident_check(scope)
    personas.createOrReplaceTempView(PERSONAS)
    (read_rows(spark, (), "user_email string, group_name string") if members is None else members).createOrReplaceTempView(MEMBERS)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {CALLER} STRING DEFAULT current_user()")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(row_value STRING) RETURNS BOOLEAN
        RETURN EXISTS (SELECT 1 FROM {MEMBERS} m WHERE m.user_email = session.{CALLER} AND m.group_name = {_text(admins)})
            OR EXISTS (SELECT 1 FROM {PERSONAS} p WHERE p.user_email = session.{CALLER} AND p.{scope} = {_text(everything)})
            OR EXISTS (SELECT 1 FROM {PERSONAS} p WHERE p.user_email = session.{CALLER} AND p.{scope} = {name}.row_value)""")


@contextmanager
def calling_as(spark: SparkSession, caller: str | None) -> Iterator[None]:
    """Queries written inside are the caller's, also if they run later; None stands for the session's user."""
    if caller is not None:
        spark.sql(f"SET VARIABLE {CALLER} = :caller", args={"caller": caller})
    try:
        yield
    finally:
        spark.sql(f"SET VARIABLE {CALLER} = DEFAULT")


def visible(df: DataFrame, name: str, column: str, caller: str | None = None) -> DataFrame:
    """The rows of ``df`` that the row filter ``name`` on ``column`` lets the caller see."""
    ident_check(name)
    spark = df.sparkSession
    with calling_as(spark, caller):
        return spark.sql(f"SELECT * FROM {{rows}} WHERE {name}(IDENTIFIER(:column))", args={"column": f"`{column}`"}, rows=df)
