"""Documents that every operator must take: nulls, empty and very long texts,
repeated rows, and extra columns whose names operators use inside."""
import random

CLASHES = ["h", "fp", "sig", "n", "key", "value", "comp", "bucket", "score", "tokens", "part", "size", "hilbert", "term", "d2", "kept"]
RND = random.Random(5)
LONG = " ".join(RND.choice(["alpha", "beta,", "gamma.\n", "delta", "ε", "日本", "7", "\t", "don't"]) for _ in range(40_000)) + "x" * 50_000
ROWS = [
    (None, None, None, None), (None, "", "en", "a"), (1, "", None, "a"), (1, "", None, "a"), (2, None, "en", None),
    (3, "one two three four", "en", "a"), (3, "one two three four", "en", "a"), (3, "another text under the same id", "en", "a"),
    (4, LONG, "en", "b"), (5, LONG, "en", "b"), (6, " \n\t ", "en", "b"), (7, "😀 é ß <|im_end|> <|endoftext|>", "de", "c"),
    (-8, "token = abcdef123456", "en", "b"), (9, "ONE two THREE four", "en", "b"), (None, "one two three four", "xx", "q"),
]


def edge_docs(spark, rows=ROWS):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    data = [(*r, len(r[1]) if r[1] is not None else None, *(["?"] * len(CLASHES))) for r in rows]
    return spark.createDataFrame(data, schema)


def key(row):
    return tuple((x is not None, x) for x in row)


def load(spark, sf, name):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")
