"""Row-wise operators of the training data subpackage against brute force: packing, personal data, overlap, shards."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import ROOT

from ledgerloom.llm.decontam import overlap_report, remove_contaminated
from ledgerloom.llm.packing import Windows, pack
from ledgerloom.llm.pii import mask_pii, pii_report
from ledgerloom.llm.sharding import byte_shards
from ledgerloom.llm.tokens import WordIds, default_path

SCHEMA = "doc_id long, text string, spans string, id string, key long, size int"


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "s", "i", 1, 2) for i, t in rows], SCHEMA)


ODD = [(1, None), (2, ""), (3, "x" * 30_000), (3, "x" * 30_000), (None, "no id"), (5, "It's 12.5 <|endoftext|> Ünï … a.b!!c \x1c İI")]


def test_word_ids_equal_those_of_the_tokenizer(spark):
    import pyarrow as pa

    texts = [t or "" for _, t in ODD] + [r.text for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("text").collect()]
    ids, bounds = WordIds(default_path()).of(pa.array(texts))
    want = WordIds(default_path()).encode(texts)
    assert [list(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])] == want


@pytest.mark.parametrize("window", [16, 2048])
def test_packing_is_a_gapless_round_trip(spark, window):
    docs = [(100 + r.doc_id, r.text) for r in spark.read.parquet(f"{ROOT}/documents.parquet").limit(60).collect()] + [(i, t) for i, t in ODD if i not in (3, None)]
    got = pack(frame(spark, docs).coalesce(2), window=window, with_ids=True).collect()
    encode = WordIds(default_path()).encode
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for i, t in docs:
        want = encode([t or ""])[0] + [1]
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert [x for r in pieces for x in r.ids] == want and {r.doc_tokens for r in pieces} == {len(want)}
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
    fills = []
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(p.length for p in rows[:k]) for k in range(len(rows))]
        fills.append(sum(r.length for r in rows))
    assert max(fills) <= window and sum(f < window for f in fills) <= 2  # one open window per task


def test_packing_repeats_nulls_and_nothing(spark):
    got = pack(frame(spark, ODD)).collect()
    assert sum(r.length for r in got if r.doc_id == 3) == 2 * got[[r.doc_id for r in got].index(3)].doc_tokens
    assert {r.doc_tokens for r in got if r.doc_id in (1, 2)} == {1} and any(r.doc_id is None for r in got)
    assert pack(frame(spark, [])).count() == 0


def test_pieces_go_where_the_sum_of_squares_grows_least():
    w = Windows(10)
    for n in (6, 6, 6, 3):
        list(w.add("d", np.zeros(n)))
    # level 6 had three windows: leaving it for level 9 costs least
    assert w.level[6] == 2 and w.level[9] == 1
    assert [sum(len(p[2]) for p in s) for s in w.add("d", np.zeros(4))] == [10]
    rest = [sum(len(p[2]) for p in s) for s in w.level_out()]
    assert sum(rest) == 6 + 9 and sorted(rest) == [5, 10]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    d = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


PII = [
    (11, "mail me: a@b.c@d.e and a@b.c_d@e.f x 10.0.0.1 999.1.1.1 1.2.3.4.5 Card 4111 1111 1111 1111, +49 (0)30 1234-567 "),
    (12, "é " * 50 + "IBAN DE89 3704 0044 0532 0130 00 x DE89 3704 0044 0532 0130 01"), (13, "1-" * 20_000 + " 4111111111111111"),
    (14, "a" * 50_000 + "@"), (15, "00255.1.1.1 " + "9" * 3000), (16, "+1 2" * 2000),
]


def test_personal_data_against_plain_patterns(spark):
    docs = ODD + PII + [(100 + r.doc_id, r.text) for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()]
    got = {r.doc_id: r for r in pii_report(frame(spark, docs)).collect()}
    assert pii_report(frame(spark, ODD)).count() == len(ODD) and pii_report(frame(spark, [])).count() == 0
    for i, t in docs:
        if i == 14:  # the plain pattern is quadratic here
            continue
        spans = [(k, m.start(), m.end()) for k in PATTERNS for m in re.finditer(PATTERNS[k], t or "") if passes(k, m.group())]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), i
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(sum(s[0] == k for s in spans) for k in PATTERNS)
        assert got[i].spans.startswith(text)
    assert got[12].spans == "iban:105:132" and got[12].top_score == 1.0


def test_masking_keeps_rows_and_columns(spark):
    docs = frame(spark, ODD + PII[:2])
    got = mask_pii(docs)
    assert got.columns == docs.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[1] is None and texts[2] == "" and texts[3] == "x" * 30_000
    assert texts[11] == "mail me: <email>@d.e and <email><email> x <ip> 999.1.1.1 <ip>.5 Card <card>, <phone> "


def plain_overlap(docs, items, size):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))

    grams = {}
    for i, t in items:
        w = words(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[k: k + n]), set()).add(i)
    out = {}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k: k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found |= grams[tuple(w[k: k + n])]
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_overlap_against_plain_search(spark, broadcast_bytes):
    items = [(1, "One two three, four FIVE six seven eight nine ten eleven"), (2, "Éclair only"), (3, None), (4, ""), (10, "five six seven eight nine ten eleven twelve thirteen fourteen")]
    docs = [
        (1, None), (2, ""), (3, "a one two three four five six seven eight nine ten eleven twelve thirteen fourteen b"), (4, "an Éclair ONLY; éclair only"),
        (5, "one two three four five six seven eight nine ten " * 400), (6, "one two three four five six seven eight nine"), (6, "one two three four five six seven eight nine"), (None, "éclair only"),
    ]
    clash = spark.createDataFrame([(i, t, "c", 1) for i, t in items], "item_id long, text string, code string, size int")
    got = overlap_report(frame(spark, docs), clash, broadcast_bytes=broadcast_bytes).collect()
    want = plain_overlap([(i, t) for i, t in docs if i is not None], items, 10)
    assert len(got) == len(docs)
    for r in got:
        if r.doc_id is not None:
            # 'É' is outside A-Z and stays
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[r.doc_id], r.doc_id
    left = remove_contaminated(frame(spark, docs), clash, broadcast_bytes=broadcast_bytes)
    assert left.columns == frame(spark, docs).columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == sorted([i or 0 for i, _ in docs if i is not None and not want[i][4]] + [0])
    assert overlap_report(frame(spark, docs), clash.limit(0)).filter("contaminated").count() == 0
    assert overlap_report(frame(spark, []), clash).count() == 0


def test_shards_are_contiguous_and_even(spark):
    rows = [(r.doc_id + 10, r.text) for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").collect()] + [(1, None), (2, ""), (3, "dup"), (3, "dup"), (None, "é")]
    got = byte_shards(frame(spark, rows), shards=7).collect()
    assert len(got) == len(rows)
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    ids = [r.doc_id for r in order]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    for s in range(7):
        assert [r.slot for r in order if r.shard == s] == list(range(sum(r.shard == s for r in order)))
    text = dict(rows)
    assert all(r.size == len((text[r.doc_id] or "").encode()) + 16 and r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) for r in got)
    total = sum(r.size for r in got)
    assert all(abs(sum(r.size for r in got if r.shard == s) - total / 7) <= max(r.size for r in got) for s in range(7))
    assert byte_shards(frame(spark, []), shards=7).count() == 0


def test_licence_notices_are_confirmed_word_by_word(spark):
    from ledgerloom.llm.licences import NOTICES, find_licences, licence_report

    rows = [(k, f"some prose {k}\n{t}\nmore prose") for k, t in enumerate(NOTICES.values())] + [
        (50, "foo bar. Licensed under CC BY-NC 4.0. Something. Released under the MIT License. more"), (51, "Licensed under the Apache License, Version 2.1."),
        (52, "licensed by someone"), (53, None), (54, ""), (55, "x " * 20_000 + "RELEASED under the mit license" + " y" * 20_000), (None, "Released under the MIT License."),
        (56, "Released under the MIT License."), (56, "Released under the MIT License."),
    ]
    got = licence_report(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r.licences for r in got}
    assert [by_id[k] for k in range(len(NOTICES))] == list(NOTICES)
    assert (by_id[50], by_id[51], by_id[52], by_id[53], by_id[54], by_id[55], by_id[None], by_id[56]) == ("CC-BY-NC-4.0,MIT", "", "", "", "", "MIT", "MIT", "MIT")
    span = find_licences(frame(spark, rows[:1])).first().found[0]
    assert rows[0][1][span.start: span.stop] == NOTICES["MIT"] and span.missing == [] and span.reduction > 0.5
    loose = find_licences(frame(spark, [(1, "Licensed under the Apache License, Version 2.1.")]), tolerance=0.5).first().found[0]
    assert (loose.licence, loose.missing, loose.extra) == ("Apache-2.0", ["2.0"], [])
    assert licence_report(frame(spark, [])).count() == 0


def test_licence_wordings_that_are_not_in_the_tables(spark):
    from ledgerloom.llm.licences import licence_report

    said = {
        "MIT": ["SPDX-License-Identifier: MIT", "(c) Jo. The MIT License (MIT)"], "GPL-3.0": ["GNU General Public License v3", "# SPDX-License-Identifier: GPL-3.0-or-later"],
        "BSD-3-Clause": ["Under the New BSD License, as is."], "CC-BY-SA-4.0": ["Text: Creative Commons Attribution-ShareAlike 4.0 International License."],
        "Apache-2.0": ["Apache License 2.0", "the Apache Software License 2.0"],
    }
    rows = [(n, t) for n, t in enumerate(t for texts in said.values() for t in texts)]
    got = {r.doc_id: r.licences for r in licence_report(frame(spark, rows)).collect()}
    assert [got[k] for k, _ in rows] == [name for name, texts in said.items() for _ in texts]
    held = licence_report(frame(spark, [(1, "Copyright 1999 Jo. All rights reserved."), (2, "Proprietary and confidential. All rights reserved.")])).collect()
    assert {r.doc_id: (r.n_licences, r.licences, r.reserved) for r in held} == {1: (0, "", "all-rights-reserved"), 2: (0, "", "all-rights-reserved,proprietary")}


def test_licence_notices_with_a_few_other_words(spark):
    from ledgerloom.llm.licences import find_licences

    said = [
        ("Licensed under Apache License 2.0", ["Apache-2.0"]), ("Licensed under the MIT Licence", ["MIT"]), ("Licensed under the Apche License, Version 2.0.", ["Apache-2.0"]),
        ("This work is licenced under the GNU General Publik License, version 3.", ["GPL-3.0"]), ("This work is licensed under the GNU General Public License, version 4.", []),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]), ("Licensed under CC BY-ND 4.0.", ["CC-BY-ND-4.0"]),
        ("This work is now licensed under the GNU General Public License, version 2. Released under the MIT License.", ["GPL-2.0", "MIT"]),
        ("Released under the MIT License. Also: Released under the MIT License.", ["MIT", "MIT"]), ("see http://www.apache.org/licenses/LICENSE-2.0", ["Apache-2.0"]),
    ]
    got = {r.doc_id: r.found for r in find_licences(frame(spark, [(k, t) for k, (t, _) in enumerate(said)])).collect()}
    assert [sorted(f.licence for f in got[k]) for k in range(len(said))] == [names for _, names in said]
    assert [(f.missing, f.extra) for f in got[7] if f.licence == "GPL-2.0"] == [([], ["now"])]
    assert [said[3][0][f.start: f.stop] for f in got[3]] == [said[3][0]] and got[3][0].extra == ["publik"]


def test_licence_notices_over_several_lines(spark):
    from ledgerloom.llm.licences import WORDINGS, find_licences, licence_report

    grant = WORDINGS["MIT"][0].split()
    lines = "\n".join(" *  " + " ".join(grant[k:k + 7]) for k in range(0, len(grant), 7))
    far = " ".join(f"w{k}" for k in range(3000))
    rows = [(1, "Licensed under the Apache License,\nVersion 2.0"), (2, "# Licensed under the Apache\n#   License,\n# Version 2.0"), (3, f"/*\n{lines}\n */\nint x;"),
            (4, f"All rights\r\n// reserved. {far}\nReleased under\nthe MIT License. {far}")]
    got = {r.doc_id: (r.licences, r.reserved, r.n_candidates) for r in licence_report(frame(spark, rows)).collect()}
    assert got == {1: ("Apache-2.0", "", 1), 2: ("Apache-2.0", "", 1), 3: ("MIT", "", 1), 4: ("MIT", "all-rights-reserved", 2)}
    house = "\n".join(f"clause {k} of the house terms says that item {k} is kept" for k in range(100))
    found = find_licences(frame(spark, [(1, f"before\n{house}\nafter")]), notices={"House": house}).first().found
    assert [(f.licence, f.start, f.stop, f.missing, f.extra) for f in found] == [("House", 7, 7 + len(house), [], [])]
    many = find_licences(frame(spark, [(1, "Released under the MIT License.\n" * 3000)])).first().found
    assert len(many) == 3000 and {f.licence for f in many} == {"MIT"} and many[1].start == 32
