"""Small tables with every awkward case, shared by the tests of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PROSE = ("the of and a to in is that it was for on are with as be this have from or one had by word but not "
         "what all were we when your can said there use an each which she do how their if will up other about "
         "out many then them these so some her would make like him into time has look two more write go see").split()

#: Names that operators use inside; as extra columns they must do no harm.
CLASHES = ("_id", "_key", "_uid", "_row", "_text", "_label", "_digest", "_n", "_keep", "label", "score", "kept",
           "n", "bucket", "uid", "root", "epoch", "domain", "n_tokens", "cut_key", "host", "verdict", "round", "start")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(PROSE[(x >> 8) % len(PROSE)] + str((x >> 16) % 50))
    return " ".join(out)


def rows() -> list[tuple]:
    long = prose(99, 60_000)
    return [
        (1, prose(1, 120), "en", "src0", 500), (2, prose(1, 120), "en", "src1", 500),
        (3, prose(1, 120).replace(" ", "  \n"), "en", "src0", None), (4, None, "en", "src0", 0),
        (5, "", None, "src2", 0), (6, " \t\n\x0b\x0c\r ", "de", None, 7), (7, "one two three", "fr", "src3", 13),
        (8, long, "en", "src0", len(long)), (9, "\x00 odd   bytes \U0001f600 é", "es", "other", 20),
        (None, prose(2, 80), "en", "src0", 300), (None, None, None, None, None),
        (10, prose(3, 90), "en", "src4", 400), (10, prose(3, 90), "en", "src4", 400),
        (10, prose(3, 90), "en", "src4", 400), (11, prose(4, 30) + " " + prose(1, 60), "en", "src5", 500)]


def docs(spark: SparkSession, extra: bool = True) -> DataFrame:
    df = spark.createDataFrame(rows(), SCHEMA)
    if extra:
        for i, c in enumerate(CLASHES):
            df = df.selectExpr("*", f"{i} as `{c}`")
    return df.repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
