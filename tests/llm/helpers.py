"""Small document tables with the awkward rows every operator must take."""

from __future__ import annotations

from meterline.session import scratch_path

LONG = " ".join(f"word{i % 997}" for i in range(30_000)) + "."
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # Names that operators use inside.
          "id long, score double, kept boolean, fp long, part int, size long, `rank` int, path string, "
          "`__own` string, `__id` long, `__key` string, `__hash` long, curve int, shard string, slot long, "
          "row string, own string, id_ long, own_ string, h string, salt int")


def rows() -> list[tuple]:
    texts = [(1, "Alpha beta gamma."), (2, "ALPHA beta gamma."), (3, None), (4, ""), (5, LONG),
             (6, "alpha beta gamma."), (6, "alpha beta gamma."), (None, "no id here"), (7, "ÉTÉ à la plage"),
             (8, "été à la plage"), (9, "one two"), (9, "three four"), (10, "x" * 5000), (None, None)]
    return [(i, t, None if (i or 0) % 3 == 0 else "en", None if (i or 0) % 4 == 0 else f"src{i}",
             None, i, 0.5, True, 1, 2, 3, 4, "p", "o", 7, "k", 9, 5, "s", 6, "r", "w", 8, "x", "h", 1)
            for i, t in texts]


def awkward(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def stored(spark, name, **tables) -> str:
    """The tables as Parquet in a fresh folder, as a query reads them."""
    at = scratch_path(spark, name)
    for t, df in tables.items():
        df.write.parquet(f"{at}/{t}.parquet")
    return at


def text_at(sf_dir: str, table: str):
    import pandas as pd
    return pd.read_parquet(f"{sf_dir}/{table}.parquet")
