"""Row-wise operators: decontamination, quality rules, URL filter, chat formatting."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMOKE_SF
from tests.llm import brute
from tests.llm.data import awkward_rows, documents, got, pairs, passage, same
from tickwise.llm import chat, decontaminate, quality_rules, queries, url_filter

ITEMS = [(1, passage(2, 40)), (2, passage(3, 13)), (3, "One, TWO three"), (4, None), (5, ""), (6, "..."),
         (2, passage(3, 13)), (7, passage(1, 25)), (None, passage(9, 30))]
OP1 = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
OP4 = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _op1(df):
    return df.select("doc_id", "n_words", "n_hit", F.size("items").alias("n_items"),
                     decontaminate.items_digest(F.col("items")).alias("items_sha256"), "contaminated")


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 150])
def test_decontaminate_awkward(spark, block):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = awkward_rows() + awkward_rows()[8:11]
    found = decontaminate.find(documents(spark, rows), bench, block)
    same(got(_op1(found), *OP1), brute.op1(pairs(rows), ITEMS))
    hit = [r for r in found.filter("n_hit > 0").select("text", "spans", "n_hit").collect()]
    assert hit
    for text, spans, n in hit:
        assert sum(len(brute.BENCH_WORD.findall(text[a:b])) for a, b in spans) == n


def test_decontaminate_empty(spark):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.find(documents(spark, []), bench).count() == 0
    none = decontaminate.find(documents(spark), bench.limit(0))
    assert none.filter("contaminated OR n_hit > 0").count() == 0 and none.count() == len(awkward_rows())
    kept = decontaminate.clean(documents(spark), bench)
    assert kept.columns == documents(spark).columns
    assert 0 < kept.count() < len(awkward_rows())


def test_decontaminate_table(spark):
    want = brute.op1(brute.rows(SMOKE_SF, "documents", "doc_id", "text"),
                     brute.rows(SMOKE_SF, "benchmark", "item_id", "text"))
    same(got(queries.op1_decontaminate(spark, SMOKE_SF), *OP1), want)


def test_quality_awkward(spark):
    rows = awkward_rows() + awkward_rows()[:3]
    same(got(quality_rules.judge(documents(spark, rows)), *OP4), brute.op4(pairs(rows)))
    assert quality_rules.judge(documents(spark, [])).count() == 0


def test_quality_keeps_whole_rows(spark):
    docs = documents(spark)
    good = quality_rules.keep_good(docs)
    assert good.columns == docs.columns
    kept = {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept


def test_quality_is_native(spark):
    plan = queries.op4_quality_rules(spark, SMOKE_SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))


def test_quality_labels(spark):
    """The rules keep clean documents and drop most of those labelled bad."""
    judged = {r["doc_id"]: r["kept"] for r in queries.op4_quality_rules(spark, SMOKE_SF).collect()}
    words = {d: len((t or "").split()) for d, t in brute.rows(SMOKE_SF, "documents", "doc_id", "text")}
    labels = brute.rows(SMOKE_SF, "labels", "doc_id", "quality")
    clean = [judged[d] for d, q in labels if q == 1 and words[d] >= 20]
    bad = [judged[d] for d, q in labels if q == 0]
    assert sum(clean) >= 0.98 * len(clean) and sum(bad) <= 0.2 * len(bad)


URLS = [None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "http://A.NET/x?y#z", "x://net/", "http://vnet/",
        "https://example.net/en/1", "https://m.example.net/en", "http://example.com/de/a", "http://example.com/DE/a",
        "http://q.org/fr/a", "http://org/fr/", "http://a.org?x=http://b.net/", "http://a.net#/en/", "a://b://c.net/",
        "http://www.casino-win.com/a", "http://casinos.com/", "http://x.com/casino/a/b.casino.c/", "http://poker.x", "http://ads.x.fr/é?ü"]


def _many_rules():
    """Some thousand generated rules of every form, exceptions among them."""
    words = [a + b for a in ("ad", "pix", "tra", "spo", "win") for b in ("ser", "el", "ck", "nso", "go", "x1")]
    tops = ("com", "net", "org", "de", "io")
    forms = ("||{w}.{t}^", "||{w}*.{t}/", "||*.{w}.{t}/{w}/", "|www.{w}.{t}", "/{w}/*.{t}", "||*^{w}-{t}^", "{w}{t}")
    for i, (w, t, f) in enumerate((w, t, f) for w in words for t in tops for f in forms):
        for rank in range(3):
            yield url_filter.UrlRule(f"r{i}-{rank}", f.format(w=w, t=t), ("block", "allow")[(i + rank) % 2], rank)


def test_thousands_of_rules_equal_running_each(spark):
    rules = [*_many_rules()]
    assert len(rules) > 3000
    r = random.Random(9)
    words = sorted({w for rule in rules for w in url_filter.whole_tokens(rule.pattern)}) + ["www", "x", "a-b"]
    urls = [f"https://{'.'.join(r.choices(words, k=r.randint(1, 4)))}/{'/'.join(r.choices(words, k=r.randint(0, 3)))}"
            for _ in range(300)]
    urls += [f"http://{w}.{t}/" for w in words[:20] for t in ("com", "net")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = {x.page_id: (x.rule, x.verdict) for x in url_filter.judge_urls(df, rules).collect()}
    searched = [(rule, url_filter.rule_regex(rule.pattern)) for rule in rules]
    hits = 0
    for i, url in enumerate(urls):
        target = url.partition("://")[2]
        fits = [rule for rule, regex in searched if regex.search(target)]
        best = max(fits, key=lambda x: (x.rank, len(x.name), x.name), default=None)
        hits += best is not None
        assert found[i] == ((best.name, best.verdict) if best else (None, "allow"))
    assert hits > 50


def test_urls_awkward(spark):
    rows = [*enumerate(URLS), (3, "http://"), (None, "http://a.net/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit(1)).withColumn(
        "_rank", F.lit(2))
    for block in (url_filter.RULES_PER_BLOCK, 3):
        judged = url_filter.judge_urls(pages, queries.url_rules(), rules_per_block=block)
        found = judged.withColumn("site", F.when(F.col("rank") == 1, F.col("rule"))).select(
            "page_id", "host", "path", "site", "verdict").collect()
        want = brute.op2(rows, queries.SITE_RULES)
        same([r[:4] for r in found], [w[:4] for w in want])
        by_host = {r["host"]: r["verdict"] for r in found}
        assert by_host["www.casino-win.com"] == "block" and by_host["casinos.com"] == "allow"
        assert by_host["x.com"] == "allow" and by_host["poker.x"] == "block" and by_host["ads.x.fr"] == "block" and by_host["a.org"] == "allow"
        named = {r["page_id"]: r["verdict"] for r in found if r["site"]}
        assert named == {w[0]: w[4] for w in want if w[3]}
    assert url_filter.judge_urls(pages.limit(0), queries.url_rules()).count() == 0


def test_rule_index():
    rules = [url_filter.UrlRule("r1", "||example.com/ads/", "block"), url_filter.UrlRule("r2", "track*", "block")]
    index = url_filter.rule_index(rules, {"example": 90, "com": 900, "ads": 5})
    assert [r.name for r, _ in index["ads"]] == ["r1"] and [r.name for r, _ in index[""]] == ["r2"]
    assert url_filter.best_rule("a.example.com/ads/x", index).name == "r1"
    assert url_filter.best_rule("example.com/ad/mytracker", index).name == "r2"
    assert url_filter.best_rule("example.org/ads/x", index) is None


LOG = "conv_id bigint, seq bigint, kind string, msg bigint, role string, text string"


def _fold(events):
    """Plain replay of one conversation's events."""
    out = {}
    for _, kind, msg, role, text in sorted(events, key=lambda e: e[0]):
        if kind == "regenerate":
            out = {m: v for m, v in out.items() if m < msg}
        elif kind == "edit" and msg in out:
            out[msg] = [out[msg][0], text]
        else:
            out.setdefault(msg, [role, ""])[1] += text
    return {m: v[1] for m, v in out.items()}


def test_chat_events(spark):
    rnd, rows, want = random.Random(5), [], {}
    for conv in (1, 2, 3, None):
        events = [(s, rnd.choice(["delta", "delta", "message", "edit", "regenerate"]), rnd.randint(0, 4), "user",
                   rnd.choice(["x", "yy", "\\", "<|end|>", ""])) for s in range(60)]
        rows += [(conv, *e) for e in events]
        want |= {(conv, m): t for m, t in _fold(events).items()}
    rnd.shuffle(rows)
    log = spark.createDataFrame(rows, LOG).withColumn("n", F.lit(7)).withColumn("live", F.lit(7))
    assert {(r["conv_id"], r["msg"]): r["text"] for r in chat.fold(log).collect()} == want
    assert chat.digests(chat.render(chat.fold(log.limit(0)))).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="\\<|>/s[INST] turnedx\n", max_size=60))
def test_unescape_inverts(text):
    out = text.replace("\\", "\\\\")
    for c in chat.CONTROL:
        out = out.replace(c, c[0] + "\\" + c[1:])
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROL)


def test_chat_turns(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "<|text|>b\\"), (1, 1, "assistant", "<|text|>b\\"), (1, 2, None, None),
             (1, 3, "assistant", ""), (2, 0, "a<|end|>\n", "\n"), (None, 0, "user", "</s>[INST]"),
             (0, 0, "assistant", "zero"), (3, 5, "assistant", "x" * 200_000), (3, None, "user", "first")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn(
        "seq", F.lit("z"))
    out = chat.digests(chat.render(chat.fold(chat.log_of_turns(df))))
    want = brute.op3([(c, -1 if t is None else t, r, x) for c, t, r, x in turns])
    same(got(out, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"), want)


def test_chat_table(spark):
    control = "</s>[INST] ok [/INST]"
    turns = brute.rows(SMOKE_SF, "conversations", "conv_id", "turn", "role", "text")
    want = brute.op3([*turns, (-7, 0, "user", control), (-7, 1, "assistant", control)])
    same(got(queries.op3_chat_format(spark, SMOKE_SF), "conv_id", "n_turns", "turns_sha256", "loss_chars",
             "loss_sha256"), want)
