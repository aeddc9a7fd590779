"""Small tables with every awkward row, shared by the operators' tests."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that the operators use inside.
    T.StructField("body", T.StringType()), T.StructField("node", T.IntegerType()),
    T.StructField("score", T.StringType()), T.StructField("anchor", T.DoubleType()),
])


def words(seed, n, stems="the of and er ing tion an re on th in es"):
    rng = random.Random(seed)
    stems = stems.split()
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows():
    """Documents: nulls, empty and very long texts, exact and near copies, shared passages, repeated rows."""
    passage = words(1, 90)
    base = words(2, 200)
    near = base.split()
    near[100] = "changed"
    long = words(3, 20_000)
    texts = {
        1: base, 2: base, 3: " ".join(near), 4: words(4, 60) + " " + passage + " " + words(5, 60),
        5: words(6, 30) + "\n" + passage + "\t" + words(7, 10), 6: None, 7: "", 8: " \n\t ", 9: "one", 10: "one two three",
        11: "One TWO three", 12: long, 13: words(8, 40) + " " + " ".join(long.split()[500:600]),
        14: "a" * 700, 15: "é" * 150, 16: passage, 17: "12 %% 34", 18: "日本 語 " * 80, 19: words(9, 50) + "\x00\x1f",
        20: "x y " * 100,
    }
    out = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, None, "b", 1, "s", 0.5) for i, t in texts.items()]
    out.append((1, base, "en", "s1", None, "b", 1, "s", 0.5))  # a repeated row
    out.append((None, words(10, 50), "en", "s1", None, None, None, None, None))
    return out


def documents(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, DOCUMENTS)


def saved(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
