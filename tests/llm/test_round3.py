"""Byte-level BPE, collocations and the prefix trie against libraries and brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE_SF
from tests.llm import brute
from tests.llm.data import awkward_rows, documents, got, pairs, same
from tickwise.llm import byte_bpe, collocations, prefix_trie, pretokens, queries

OP11 = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
OP12 = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
OP13 = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SIGNS = [" ", " ", "  ", "'", "'s", "'re", "'ll", "'l", "t", "ve", "m", "B", "1", "²", "Ⅷ", "!", "?", "\n", "\t",
         " ", "　", "\u0085", "é", "日", "😀", "́", "\r\n", "<|endoftext|>", "x" * 70, "ſ", "Ǆ"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.load_ranks(queries.ranks_path())
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts(n, seed=5, most=40):
    r = random.Random(seed)
    return ["".join(r.choice(SIGNS) for _ in range(r.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("room", [200, 1 << 20])
def test_ids_equal_the_librarys(library, monkeypatch, room):
    monkeypatch.setattr(byte_bpe, "ROOM", room)
    ranks, enc = library
    table, code = pretokens.class_table(byte_bpe.tiktoken_classes()), byte_bpe.slice_coder(ranks)
    texts = [*_texts(4000), *_texts(3, seed=6, most=20_000), "x" * 5000, " " * 3000, "'" * 500, ""]
    ids = byte_bpe.code_texts([t.encode() for t in texts], table, code)
    for t, i in zip(texts, ids, strict=True):
        assert np.frombuffer(i, "<u4").tolist() == enc.encode_ordinary(t), t[:80]


def test_every_code_point_has_the_librarys_class(library):
    _, enc = library
    ranks, _ = library
    table, code = pretokens.class_table(byte_bpe.tiktoken_classes()), byte_bpe.slice_coder(ranks)
    every = pretokens.all_characters()
    texts = ["".join(f"a{c} {c}1" for c in every[i:i + 2000]) for i in range(0, len(every), 2000)][:120]
    for t, i in zip(texts, byte_bpe.code_texts([t.encode() for t in texts], table, code), strict=True):
        assert np.frombuffer(i, "<u4").tolist() == enc.encode_ordinary(t)


def test_both_merges_agree(library):
    ranks, _ = library
    r = random.Random(1)
    for n in (2, 3, 10, 31, 32, 33, 200):
        for _ in range(30):
            piece = bytes(r.choice(b"abcx \xc3\xa9") for _ in range(n))
            if piece not in ranks:
                assert byte_bpe.merge_short(piece, ranks) == byte_bpe.merge_pairs(piece * 1, ranks)
    long = bytes(r.choice(b"ab") for _ in range(60))
    assert byte_bpe.merge_short(long, ranks) == byte_bpe.merge_pairs(long, ranks)


def test_transitions_are_a_scan():
    """The scan's states are those of one step after the other."""
    r = np.random.default_rng(2)
    kinds = r.integers(0, pretokens.CLASSES, 20_000).astype(np.uint8)
    first = r.random(20_000) < 0.01
    first[0] = True
    state, want = pretokens.END, []
    for k, f in zip(kinds.tolist(), first.tolist(), strict=True):
        state = pretokens.END if f else state
        want.append(state)
        state, _ = pretokens.step(state, k)
    assert pretokens.states_before(kinds, first).tolist() == want


def _op11(enc, docs):
    out = []
    for doc, text in docs:
        ids = enc.encode_ordinary(text or "")
        out.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return out


def _digests(df):
    return df.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                     F.sha2("body", 256).alias("decoded_sha256"))


def test_bpe_awkward(spark, library):
    _, enc = library
    rows = awkward_rows()
    coded = byte_bpe.encode(documents(spark, rows), queries.ranks_path, byte_bpe.tiktoken_classes())
    same(got(_digests(byte_bpe.decode(coded, queries.ranks_path)), *OP11), _op11(enc, pairs(rows)))
    assert byte_bpe.encode(documents(spark, []), queries.ranks_path, byte_bpe.tiktoken_classes()).count() == 0
    # any range of tokens, by the offsets that were kept
    whole = {r.doc_id: bytes(r.body) for r in byte_bpe.decode(coded, queries.ranks_path).collect()}
    ids = {d: enc.encode_ordinary(t or "") for d, t in pairs(rows)}
    for r in byte_bpe.decode(coded, queries.ranks_path, first=3, count=5).collect():
        assert bytes(r.body) == b"".join(map(enc.decode_single_token_bytes, ids[r.doc_id][3:8]))
        assert whole[r.doc_id][r.at:r.at + len(r.body)] == bytes(r.body)


def test_bpe_ill_formed(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62C328' AS STRING) AS text")
    coded = byte_bpe.encode(df, queries.ranks_path, byte_bpe.tiktoken_classes())
    assert bytes(byte_bpe.decode(coded, queries.ranks_path).first().body).decode() == "a�b�("


def test_bpe_table(spark, library):
    docs = brute.rows(SMOKE_SF, "documents", "doc_id", "text")
    same(got(queries.op11_byte_bpe(spark, SMOKE_SF), *OP11), _op11(library[1], docs))


# ---------------------------------------------------------------- collocations

LINE = ["the cat sat. the cat ran, THE CAT sat", "new york city new york city; new\tyork", "a b c d a b c d a b c",
        "x", "", None, " . , ", "hot pair one", "hot pair two", "hot pair three hot pair four", "é É a-b a-b a-b a-b"]


def _phrases(r, n=300):
    vocabulary = [f"w{i}" for i in range(12)] + ["hot", "pair", "Ä", "ß", "'"]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 30))) + r.choice([".", "\n", " "]) +
             r.choice([x or "" for x in LINE]), r.choice(["en", "de", None, "und"])) for i in range(n)]
    return rows + [(n + i, t, "en") for i, t in enumerate(LINE)] + [(None, None, None)]


@pytest.fixture(params=["whole", "split"])
def cut(request, monkeypatch):
    """As it is, and with stripes split by their elements, short runs of words and short stretches."""
    if request.param == "split":
        monkeypatch.setattr(collocations, "WIDE", 2)
        monkeypatch.setattr(collocations, "WORDS", 7)
        monkeypatch.setattr(collocations, "STRETCH", 50)
        monkeypatch.setattr(collocations, "SHARES", 3)


@pytest.mark.parametrize(("least", "top"), [(10, 2000), (2, 25)])
def test_collocations(spark, cut, least, top):
    rows = _phrases(random.Random(3))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    for name in ("n", "prefix", "part", "kind", "phrase", "score", "next"):
        df = df.withColumn(name, F.lit("extra"))
    found = got(collocations.collocations(df, least=least, top=top), *OP12)
    want = brute.op12(rows, least, top)
    assert len(want) > 10
    same(found, want)


def test_collocations_edges(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(none).count() == 0
    blank = spark.createDataFrame([(None, "en"), ("  ", "en"), (". ,", None)], "text string, lang string")
    assert collocations.collocations(blank).count() == 0
    ill = spark.sql("SELECT decode(encode(repeat('a ', 12), 'utf-8'), 'utf-8') AS text, 'en' AS lang UNION ALL "
                    "SELECT CAST(unhex(repeat('61FF2062FE2E', 12)) AS STRING), 'en'")
    rows = collocations.collocations(ill).select(F.col("phrase").cast("binary").alias("b"), "a").collect()
    # "a a" is held by "a a a"
    assert {(bytes(r.b).decode(), r.a) for r in rows} == {("a\ufffd b\ufffd", 12), ("a a a", 10)}


def test_score_is_exact(spark):
    a, x, y = 3 * 10 ** 14 + 7, 9 * 10 ** 14 + 1, 8 * 10 ** 14 + 3
    df = spark.createDataFrame([(a, x, y), (10, 10, 10), (10, 3 * 10 ** 9, 10 ** 10)], "a bigint, l bigint, r bigint")
    found = df.select(collocations.score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert [r[0] for r in found] == [10 ** 6 * a * a // (x * y), 10 ** 6, 0]


def test_collocations_table(spark):
    rows = brute.rows(SMOKE_SF, "documents", "doc_id", "text", "lang")
    same(got(queries.op12_collocations(spark, SMOKE_SF), *OP12), brute.op12(rows))


# ---------------------------------------------------------------- prefix trie

def _talks():
    r = random.Random(7)
    rows = []
    for c in [*range(-12, 60), 1000, 10 ** 12]:
        n = r.choice([1, 2, 3, 5, 9, 12])
        own = [(r.choice([None, *range(6)]), r.choice(["user", "assistant", None]), r.choice(["hi", "", None, "é日", "yes"]))
               for _ in range(n)]
        if c % 7 == 0:
            own = [(i, "user", "same") for i in range(n)]
        rows += [(c, *t) for t in own]
    rows += [(3, 1, "user", "hi")] * 3 + [(None, 1, "user", "nobody's"), (None, None, None, None)]
    return rows


TALK = "conv_id bigint, turn bigint, role string, text string"


@pytest.fixture(params=["whole", "cut"])
def tour(request, monkeypatch):
    if request.param == "cut":
        monkeypatch.setattr(prefix_trie, "BLOCK", 2)
        monkeypatch.setattr(prefix_trie, "SHARES", 3)
        monkeypatch.setattr(prefix_trie, "BASE", 200)


def test_prefix_trie(spark, tour):
    rows = _talks()
    df = spark.createDataFrame(rows, TALK).withColumns({n: F.lit("x") for n in ("node", "parent", "d", "conv", "place")})
    same(got(prefix_trie.prefix_trie(df), *OP13), brute.op13(rows))


def test_prefix_trie_edges(spark):
    none = spark.createDataFrame([], TALK)
    assert prefix_trie.prefix_trie(none).count() == 0
    # a long conversation, one that is left without turns, and one turn alone
    long = [(10, i, "user", f"t{i}") for i in range(300)]
    rows = long + [(11, 0, "user", "gone"), (6, 0, "user", "gone"), (7, 0, None, None)]
    same(got(prefix_trie.prefix_trie(spark.createDataFrame(rows, TALK)), *OP13), brute.op13(rows))


def test_places_of_a_long_key(spark):
    rows = [(1, i // 3) for i in range(900)] + [(2, 5), (3, None)] + [(4, 7)] * 400
    df = spark.createDataFrame(rows, "k bigint, o bigint").repartition(5)
    out = prefix_trie.placed(df, "k", [F.col("o").asc_nulls_first()], "test").collect()
    for key in (1, 2, 3, 4):
        own = sorted((r.place, r.o) for r in out if r.k == key)
        assert [p for p, _ in own] == list(range(len(own)))
        assert [o for _, o in own] == sorted((o for _, o in own), key=lambda o: (o is not None, o))


def test_tour_sums_by_contraction(spark):
    """A long list, in any order, against its running sums."""
    r = random.Random(4)
    names = r.sample(range(10 ** 9), 2000)
    rows = [(a, b, i % 7, i) for i, (a, b) in enumerate(zip(names, [*names[1:], None], strict=True))]
    want, x, y = {}, 0, 0
    for a, _, p, q in rows:
        want[a] = (x, y)
        x, y = x + p, y + q
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "arc bigint, next bigint, leaves bigint, saved bigint")
    out = prefix_trie.tour_sums(df, base=300).collect()
    assert {r.arc: (r.leaves, r.saved) for r in out} == want


def test_prefix_trie_table(spark):
    rows = brute.rows(SMOKE_SF, "conversations", "conv_id", "turn", "role", "text")
    same(got(queries.op13_prefix_trie(spark, SMOKE_SF), *OP13), brute.op13(rows))
