"""Small tables with the awkward cases: nulls, blanks, ties, repeats, long texts, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def passage(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9))) for _ in range(n))


def awkward_rows():
    long = passage(1, 30_000)
    near = passage(2, 200).split()
    changed = [*near[:100], "changed", *near[101:]]
    shared = passage(3, 120)
    texts = [None, "", "   ", "\n\t\r\n", "one", "one two three four", passage(4, 49), passage(5, 50),
             long, " ".join(near), " ".join(changed), " ".join(near), passage(6, 60) + " " + shared,
             shared + "\n" + passage(7, 60), passage(8, 30) + " " + shared + " " + shared,
             "aaaa " * 300, "x" * 3000, "ÄÖü straße Ñandú 日本語 😀 " * 40, "a\\b <| </s> [INST] \x1c\x85\u2028 b  c \n d",
             "the line\nthe line\nthe line\n" * 12, "### $$$ *** &&& " * 30, passage(9, 700),
             "it's John's  <|endoftext|>  we'll   \n\n  x\t y", passage(10, 20) + " " + long[:9000]]
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, None if t is None else len(t))
            for i, t in enumerate(texts)]
    rows.append((None, passage(11, 80) + " " + shared, None, None, None))
    return rows


def documents(spark, rows=None):
    """The rows in a frame with extra columns whose names operators use themselves."""
    df = spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)
    for name in ("n_words", "kept", "h", "a", "c", "node", "size", "copies", "items", "spans", "_row", "_text",
                 "least", "cuts", "target", "one", "ids"):
        df = df.withColumn(name, F.lit("extra"))
    return df


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def same(found, expected):
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, expected), key=str)
