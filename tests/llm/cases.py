"""Small tables with odd rows that all tests of this folder share."""
import random

WORDS = "the of and river stone house window garden yellow market paper silver forest animal letter winter summer river bridge".split()


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "", ",", ".", "a", "er", "ing", "é"]) for _ in range(n))


def rows():
    """doc_id, text, lang, source, n_chars: nulls, empty, white space, copies, near copies, a very long text, a repeated row."""
    base = prose(1, 200)
    near = base.replace(base.split()[50], "changed", 1)
    out = [(i, prose(i, 20 + 7 * i), ("en", "fr", "de", "es")[i % 4], f"src{i % 3}", 1) for i in range(10, 40)]
    out += [(1, base, "en", "s", 1), (2, base, None, None, None), (3, near, "en", "s", 1), (4, None, "en", "s", 1), (5, "", "en", "s", 0)]
    out += [(6, " \n\t ", "en", "s", 4), (7, "one two", "en", "s", 7), (8, "one two", "en", "s", 7), (9, prose(9, 40_000), "en", "s", 1)]
    out += [(None, "no id here at all", "en", "s", 1), (1, base, "en", "s", 1), (50, "<|endoftext|> İstanbul ﬁne é don't 12,5 …,  x ÷, naïve!", "en", "s", 1)]
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, extra=False):
    df = spark.createDataFrame(rows(), SCHEMA)
    if extra:
        # Names that operators use themselves.
        for name in ("node", "size", "score", "id", "shard", "label", "start", "rate", "component_id", "kind", "y0"):
            df = df.selectExpr("*", f"doc_id as {name}")
    return df


def labels(spark):
    found = [(i, i % 2, int(i % 5 == 0)) for i in range(10, 40)]
    return spark.createDataFrame([*found, (1, 1, 0), (None, 1, 1), (2, None, None), (1, 1, 0), (999, 0, 1)], "doc_id long, quality int, toxic int")


def benchmark(spark):
    return spark.createDataFrame([(0, prose(12, 104).split(" ", 20)[-1][:160]), (1, None), (2, ""), (None, "x y"), (3, "unrelated words nobody wrote anywhere in these texts at all today")], "item_id long, text string")
