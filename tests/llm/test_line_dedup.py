from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from merchlens.llm import line_dedup
from tests.llm.conftest import frame, prose


def brute(rows, least=10):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(2**63 - 1 if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        own = 2**63 - 1 if i is None else i
        kept = [x for x in lines if len(key(x)) < least or min(holders[key(x)]) == own]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((repr(i), len(lines), len(lines) - len(kept), digest))
    return sorted(out)


def rows():
    shared = ["Terms of use apply here.", "  terms of USE apply here.\t", "short", "Élan vital über alles", "x" * 10]
    out = []
    for i in range(40):
        lines = [prose(i, 8), shared[i % 5], "", prose(i % 7, 6), shared[(i + 1) % 5], prose(i % 7, 6)]
        out.append((i * 2, "\n".join(lines)))
    return out + [(3, None), (5, ""), (None, "Terms of use apply here.\nnew line of nobody"), out[4], (81, "a\n" * 500 + "x" * 10)]


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_brute_force(llm, batches):
    docs = frame(llm, rows()).withColumn("n_lines", F.lit("clash")).withColumn("gone", F.lit(1))
    out = line_dedup.dedup_lines(docs, batches=batches)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "gone", "n_lines", "n_dropped"]
    got = [(repr(r.doc_id), r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in out.collect()]
    assert sorted(got) == brute(rows())


def test_runs_are_merged_by_level(llm):
    runs = line_dedup.LineRuns(llm, fan_in=2)
    for batch in range(5):
        pairs = llm.createDataFrame([(batch, h, h) for h in range(batch, batch + 3)], "id bigint, h1 bigint, h2 bigint")
        dropped = sorted(tuple(r) for r in runs.add(pairs).collect())
        assert dropped == ([(batch, batch), (batch, batch + 1)] if batch else [])
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted(r.h1 for run in runs.runs() for r in run.collect()) == list(range(7))
    runs.close()


def test_empty_table(llm):
    assert line_dedup.dedup_lines(frame(llm, [])).count() == 0


def test_lists_of_rows_without_id_are_those_of_one_text(llm):
    """A third of the rows have no id; none of the lists of dropped lines holds more than its own text's."""
    lines = [prose(i, 6) for i in range(30)]
    docs = [(i, lines[i]) for i in range(30)] + [(None, f"{lines[i]}\n{lines[(i * 7 + 1) % 30]}\nown {i}") for i in range(30)]
    docs += [(50, lines[3]), (50, lines[4])]
    got = line_dedup.dropped_lines(frame(llm, docs)).collect()
    assert len(got) == 32 and max(len(r.gone) for r in got) == 2
    named = frame(llm, docs).withColumns({n: F.lit("clash") for n in ("row", "id", "made", "__key", "a.b")})
    out = line_dedup.dedup_lines(named)
    assert out.columns == [*named.columns, "n_lines", "n_dropped"]
    got = [(repr(r.doc_id), r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in out.collect()]
    assert sorted(got) == brute(docs)
    assert {r.row for r in out.collect()} == {"clash"}


def test_very_long_text(llm):
    docs = [(1, "one shared line"), (2, "\n".join(["one shared line", *(f"line number {i}" for i in range(60_000))]))]
    out = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(frame(llm, docs)).collect()}
    assert out == {1: (1, 0), 2: (60_001, 1)}
