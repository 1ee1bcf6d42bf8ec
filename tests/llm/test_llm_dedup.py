import hashlib
import random

import duckdb
import pyarrow.parquet as pq
import pytest
from llm_cases import MEDIUM, SMALL, SPACE, documents, frame, lower, prose, session, words  # noqa: F401
from pyspark.sql import functions as F

from plinth.llm import exact_dedup, graph, near_dedup
from plinth.llm.graph import components


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(hashlib.sha256(SPACE.sub("", t or "").encode()).hexdigest(), []).append((i, t or ""))
    out = []
    for sha, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        out += [(i, keep, len(own), i == keep, sha) for i, _ in own]
    return sorted(out, key=str)


def test_exact_cases(session):
    rows = documents()
    got = sorted(map(tuple, exact_dedup.exact_dedup(frame(session, rows)).collect()), key=str)
    assert got == brute_exact(rows)


def test_exact_empty_table(session):
    assert exact_dedup.exact_dedup(frame(session, [])).count() == 0
    assert exact_dedup.kept_documents(frame(session, [])).count() == 0


def test_exact_matches_sql(session):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = sorted(con.sql(exact_dedup.SQL).fetchall())
    assert sorted(map(tuple, exact_dedup.op5_exact_dedup(session, SMALL).collect())) == want


def test_a_new_index_starts_no_python(session, tmp_path, monkeypatch):
    def refused(*args, **named):
        raise AssertionError("rows from a Python list start workers on every executor")

    monkeypatch.setattr(type(session), "createDataFrame", refused)
    index = exact_dedup.DigestIndex(session, path=str(tmp_path / "index"))
    assert index.table().dtypes == [("text_sha256", "string"), ("keep_id", "bigint"), ("group_size", "bigint")]
    assert index.table().count() == 0


def test_tables_of_wide_rows_are_written_row_by_row(session):
    rows = session.range(0, 40, 1, 1).select("id", F.expr("cast(repeat(cast(id as string), 100000) as binary)").alias("wide"))
    written = graph.written(session, rows, "wide", graph.WIDE_ROWS | {"parquet.block.size": "500000"})
    (path,) = written.inputFiles()
    assert pq.ParquetFile(path.removeprefix("file://")).metadata.num_row_groups > 4
    assert sorted(map(tuple, written.select("id", F.length("wide")).collect())) == [(i, 100_000 * len(str(i))) for i in range(40)]


def test_index_persists_and_appends(session):
    index = exact_dedup.DigestIndex(session)
    docs = lambda rows: session.createDataFrame(rows, "doc_id long, text string")
    index.ingest(docs([(1, "a b"), (2, "ab"), (3, "c")])).collect()
    again = exact_dedup.DigestIndex(session, index.name, index.path)
    second = {r["doc_id"]: r for r in again.ingest(docs([(4, "a  b "), (5, "d"), (0, "c")])).collect()}
    # the indexed document stays even if a new copy is longer or has a smaller id
    assert (second[4]["keep_id"], second[4]["kept"]) == (1, False)
    assert (second[5]["keep_id"], second[5]["kept"]) == (5, True)
    assert (second[0]["keep_id"], second[0]["kept"]) == (3, False)
    assert again.table().count() == 3


def test_exact_kept_documents_have_all_columns(session):
    rows = documents()
    docs = frame(session, rows)
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    want = {keep for _, keep, *_ in brute_exact(rows)}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(want, key=str)


def test_exact_hot_group(session):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)]
    got = sorted(map(tuple, exact_dedup.exact_dedup(session.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_exact(rows)


def shingles(text, k):
    w = words(lower(text))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_near(rows, k, percent=80):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a < b and s and t and min(len(s), len(t)) * 100 >= percent * max(len(s), len(t)):
                both = len(s & t)
                if 100 * both >= percent * (len(s) + len(t) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


@pytest.mark.parametrize("k", [4, 5])
def test_near_cases(session, k):
    rows = [r for r in documents() if r[0] is not None]
    got = sorted(map(tuple, near_dedup.near_duplicates(frame(session, rows), shingle=k).collect()))
    assert got == brute_near(rows, k)


def test_near_null_id_and_empty_table(session):
    got = near_dedup.near_duplicates(frame(session, [(None, "a b c d e f"), (1, None)])).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"]) == [(1, 1, True)]
    assert near_dedup.near_duplicates(frame(session, [])).count() == 0
    assert near_dedup.kept_documents(frame(session, [])).count() == 0


def test_near_random_edits_against_brute_force(session):
    rng = random.Random(3)
    seeds = [prose(rng, 80, 2000).split(" ") for _ in range(12)]
    rows = []
    for i in range(240):
        own = list(rng.choice(seeds))
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            own[rng.randrange(len(own))] = f"edit{i}"
        rows.append((i, " ".join(own)))
    got = sorted(map(tuple, near_dedup.near_duplicates(session.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == brute_near(rows, 5)


def test_near_links_of_members_whose_centre_is_a_short_stub(session):
    rng = random.Random(11)
    rows = []
    for family in range(30):
        words_of = lambda name, n: [f"{name}{family}x{i}" for i in range(n)]  # noqa: E731, B023
        body = words_of("s", 160)
        rng.shuffle(body)
        # both long documents begin with the stub, which has less than 80 % of their shingles
        stub, own = body[:142], 20
        rows += [(10 * family, " ".join(stub)), (10 * family + 1, " ".join(body + words_of("l", own))),
                 (10 * family + 2, " ".join(body + words_of("r", own - 2)))]
    got = sorted(map(tuple, near_dedup.near_duplicates(session.createDataFrame(rows, "doc_id long, text string")).collect()))
    want = brute_near(rows, 5)
    assert sum(not kept for *_, kept in want) == 30
    assert got == want


def test_near_keeps_one_document_of_each_component(session):
    rows = documents()
    docs = frame(session, rows)
    kept = near_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = [i for i, _, _, own in brute_near([r for r in rows if r[0] is not None], 5) if own]
    assert sorted(i for i in ids if i is not None) == sorted(set(want))


def test_near_query_on_tables(session):
    docs = session.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, near_dedup.op3_near_dedup(session, SMALL).collect()))
    assert got == brute_near([tuple(r) for r in docs], 4)
    assert near_dedup.op3_near_dedup(session, MEDIUM).count() == 1000


@pytest.mark.parametrize("edges", [500_000, 7])
def test_components_of_a_long_path_and_a_star(session, monkeypatch, edges):
    monkeypatch.setattr(graph, "LOCAL_EDGES", edges)
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(8, 30)]
    links = session.createDataFrame(path[::-1] + star + [(50, 50)], "a long, b long")
    got = dict(map(tuple, components(session, links).collect()))
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 30)}
