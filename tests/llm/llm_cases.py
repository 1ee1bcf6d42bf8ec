"""Documents with nulls, empty and very long texts, ties, repeated rows and columns with clashing names."""

import random
import re
import zlib

import pytest

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
SPACE = re.compile(r"[\x20\x09-\x0D]")
EXTRA = ("kept", "score", "_id", "_good_id", "_kept_id", "block", "shard", "bucket", "keep_id", "n_code", "rep", "trusted", "toxic_extra")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


@pytest.fixture(scope="session")
def session(spark):
    from plinth.llm.text import worker_path

    worker_path(spark)
    return spark


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % vocabulary}x" + rng.choice(["", "", ",", "."]) for _ in range(n))


def documents():
    rng = random.Random(5)
    out = [(i, prose(rng, rng.randint(20, 120))) for i in range(40)]
    out += [(40, None), (41, ""), (42, " \t\n"), (43, None), (44, "one"), (45, "One  two"), (46, "One two ")]
    out += [(47, prose(rng, 30_000, 5_000)), (48, "x" * 50_000), (49, "é" * 3_000 + " naïve café 漢字 😀")]
    out += [(50 + k, out[3][1]) for k in range(6)] + [(60, out[3][1].replace(" ", "\n", 2))]
    out += [(61, out[5][1]), (61, out[5][1]), (None, out[7][1]), (None, None)]
    near = out[9][1].split(" ")
    out += [(70 + k, " ".join(near[: 3 * k] + ["changed"] + near[3 * k + 1 :])) for k in range(4)]
    return out


def frame(spark, rows):
    full = [(i, t, None, "s", None, *("other" for _ in EXTRA)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def labels(spark, rows):
    return spark.createDataFrame([(i, 1 if i % 5 else 0, 0, "x") for i, _ in rows if i is not None and i < 40] + [(None, 1, 1, "x"), (7, None, None, "x"), (999, 1, 1, "x")],
                                 "doc_id long, quality int, toxic int, text string")
