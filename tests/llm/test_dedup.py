"""Byte, word and near-duplicate removal against brute force."""

import pytest

from tests.conftest import SMOKE_SF
from tests.llm import brute
from tests.llm.data import awkward_rows, documents, got, pairs, passage, same
from tickwise.llm import lsh_forest, phrase_dedup, queries, recurrence, spans, suffix_dedup

OP5 = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
OP10 = ("doc_id", "n_words", "n_removed", "kept_sha256")
OP9 = ("doc_id", "class_id", "n_links", "n_copies")


def _variants():
    """One passage in many surroundings, near copies, and repeats inside a text."""
    body, out = passage(20, 90), []
    for i in range(40):
        out.append((100 + i, f"{passage(200 + i, 30)} {body} {passage(300 + i, 30)}"))
    base = passage(21, 150).split()
    for i in range(12):
        out.append((200 + i, " ".join([*base[:10 * i], f"w{i}", *base[10 * i + 1:]])))
    out.append((300, " ".join([body, passage(22, 5), body])))
    return [(d, t, "en", "s", len(t)) for d, t in out]


@pytest.fixture(params=["groups", "digests", "small pieces"])
def path(request, monkeypatch):
    """The ways that equal windows are found: compared in groups, by digests, in cut texts."""
    if request.param == "digests":
        monkeypatch.setattr(recurrence, "GROUP_CONTENTS", 2)
    if request.param == "small pieces":
        monkeypatch.setattr(spans, "PIECE", 700)
        monkeypatch.setattr(recurrence, "GROUP_BYTES", 2000)
        monkeypatch.setattr(phrase_dedup, "SHARD_WINDOWS", 50)


def test_suffix_dedup_awkward(spark, path):
    rows = awkward_rows() + awkward_rows()[9:12] + _variants()
    same(got(suffix_dedup.dedup(documents(spark, rows)), *OP5), brute.op5(pairs(rows)))


def test_phrase_dedup_awkward(spark, path):
    rows = awkward_rows() + awkward_rows()[9:12] + _variants()
    same(got(phrase_dedup.dedup(documents(spark, rows)), *OP10), brute.op10(pairs(rows)))


def test_dedup_empty(spark):
    none = documents(spark, [])
    assert suffix_dedup.dedup(none).count() == 0
    assert phrase_dedup.dedup(none).count() == 0
    assert lsh_forest.join_similar(none).count() == 0


def test_dedup_tables(spark):
    docs = brute.rows(SMOKE_SF, "documents", "doc_id", "text")
    same(got(queries.op5_suffix_dedup(spark, SMOKE_SF), *OP5), brute.op5(docs))
    same(got(queries.op10_phrase_dedup(spark, SMOKE_SF), *OP10), brute.op10(docs))
    same(got(queries.op9_jaccard_join(spark, SMOKE_SF), *OP9), brute.op9(docs))


def test_run_length_index():
    bodies = [b"abracadabra", b"abracadabrx", b"", b"zzzzzz"]
    index = suffix_dedup.RunLengthIndex(bodies)
    text, found = index.text.tolist(), index.matching_statistics().tolist()
    for i in range(len(text)):
        best = 0
        for j in range(len(text)):
            k = 0
            while i != j and max(i, j) + k < len(text) and text[i + k] == text[j + k]:
                k += 1
            best = max(best, k)
        assert found[i] == best
    assert index.runs < len(text)


@pytest.mark.parametrize("block", [lsh_forest.BLOCK, 4])
def test_jaccard_join(spark, block):
    rows = _variants() + [(400 + i, t, "en", "s", 0) for i, (_, t, *_) in enumerate(_variants()[40:45])]
    rows += [(d, t, *rest) for d, t, *rest in awkward_rows() if d is not None]
    found = lsh_forest.join_similar(documents(spark, rows), block=block)
    same(got(found, *OP9), brute.op9(pairs(rows)))


def test_keep_one(spark):
    base = passage(21, 150)
    rows = [(5, base, "a", "s", 0), (3, base + " tail", "b", "s", 0), (3, base + " tail", "b", "s", 0),
            (7, None, "c", "s", 0), (8, "", "d", "s", 0), (3, passage(30, 40), "e", "s", 0), (None, passage(31, 40), "f", "s", 0)]
    docs = documents(spark, rows)
    kept = lsh_forest.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["lang"] for r in kept.collect()) == ["b", "c", "d", "e", "f"]


def test_path_length_meets_recall():
    n = lsh_forest.path_length(0.8)
    assert 1 - (1 - 0.8 ** n) ** lsh_forest.TREES >= lsh_forest.TARGET_RECALL
    assert 1 - (1 - 0.8 ** (n + 1)) ** lsh_forest.TREES < lsh_forest.TARGET_RECALL
    assert lsh_forest.path_length(0.01) == 1


LOW = ["x" * 20_000, "=-" * 9000, "abcdefg " * 900, "ab" * 300 + passage(41, 40) + "ab" * 300, "x" * 700 + "y" + "x" * 700,
       "w " * 3000, "one two " * 400 + passage(42, 60), "one two " * 100]


@pytest.mark.parametrize("small", [False, True])
def test_low_entropy(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(spans, "PIECE", 700)
    monkeypatch.setattr(recurrence, "HOT", 5)      # so that some contents are hot
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(LOW)] + awkward_rows()[9:15]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    same(got(suffix_dedup.dedup(documents(spark, rows)), *OP5), brute.op5(pairs(rows)))
    same(got(phrase_dedup.dedup(documents(spark, rows)), *OP10), brute.op10(pairs(rows)))


@pytest.mark.parametrize(("text", "most"), [("x" * 1_000_000, 100), ("=-" * 500_000, 200), ("abcdefghij" * 100_000, 600)])
def test_rows_follow_the_period(spark, text, most):
    """A long text of a short period is a few rows, and what they say is every window once."""
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    rows = recurrence.spans_of(df, "bytes", suffix_dedup.SIZE, suffix_dedup.GRAM).collect()
    assert len(rows) <= most
    assert sum(r.starts * r.repeat for r in rows) == len(text) - suffix_dedup.SIZE + 1
