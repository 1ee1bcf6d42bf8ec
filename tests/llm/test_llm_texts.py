import gzip
import hashlib
import html
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import MEDIUM, SMALL, documents, frame, labels, session, words  # noqa: F401
from tokenizers import Tokenizer

import corpus_pipeline
from plinth.llm import bpe, exact_dedup, html_extract, near_dedup, packing, quality, toxicity, warc
from plinth.session import scratch_path

ODD = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "É", "漢", "字", "1", "22", "!", "...", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", " ", "\x1c",
       "Σ", "ΑΣ", "😀", "aaaa", "\r\n", "\x85", " \n", "The", " the.", "​", "İ", "é", ".", ",", "Å", "ŉ", "Ä.", "՘", "K", "the,", "x<y"]


def odd_texts(n):
    rng = random.Random(1)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_padding()
    t.no_truncation()
    return t


# byte-level BPE


def test_bpe_equals_the_library_on_odd_texts():
    codec, lib = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY)), library(bpe.VOCABULARY)
    texts = odd_texts(3000) + [t or "" for _, t in documents()]
    ids, n = codec.encode(texts)
    ends = np.cumsum(n)
    for text, a, b, want in zip(texts, ends - n, ends, lib.encode_batch(texts, add_special_tokens=False)):
        assert ids[a:b].tolist() == want.ids, text[:80]
        assert codec.decode(want.ids) == lib.decode(want.ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_bpe_round_trip_of_any_text(text):
    codec = bpe.Codec.of(public_tokenizers.path(bpe.VOCABULARY))
    ids, _ = codec.encode([text])
    assert codec.decode(ids.tolist()) == text


def test_bpe_memory_starts_anew_when_full(monkeypatch):
    from plinth.llm import pieces

    monkeypatch.setattr(pieces, "CACHE_PIECES", 50)
    codec, lib = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY)), library(bpe.VOCABULARY)
    for text in odd_texts(60):
        assert codec.encode([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids
        assert len(codec.known) <= 60


def test_bpe_cases(session):
    rows, lib = documents(), library(bpe.VOCABULARY)
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, bpe.round_trip(frame(session, rows)).collect()), key=str) == sorted(want, key=str)
    assert bpe.round_trip(frame(session, [])).count() == 0
    back = bpe.decode(bpe.encode(frame(session, rows))).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


# packing


def check_pieces(pieces, rows, window=2048):
    lib = library(packing.TOKENIZER)
    want = sorted(lib.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows)
    own, sequences = {}, {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] > 0
    for own_pieces in sequences.values():
        at = 0
        for r in sorted(own_pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == window or at & (at - 1) == 0 and at < window
    for r in pieces:
        own.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    got = []
    for (_, total), own_pieces in own.items():
        tokens: dict[int, list] = {}
        for r in own_pieces:
            for k, x in enumerate(r["ids"]):
                tokens.setdefault(r["start"] + k, []).append(x)
        assert sorted(tokens) == list(range(total))
        copies = len(tokens[0])
        assert all(len(x) == copies for x in tokens.values())
        got += [[tokens[k][0] for k in range(total)]] * copies
    return sorted(got), want


def test_packing_cases(session):
    rows = documents()
    pieces = packing.pack(frame(session, rows), with_ids=True).collect()
    got, want = check_pieces(pieces, rows)
    assert got == want
    assert packing.pack(frame(session, [])).count() == 0


def test_word_ids_equal_the_library():
    tokenizer, lib = packing.WordTokenizer(public_tokenizers.path(packing.TOKENIZER)), library(packing.TOKENIZER)
    texts = odd_texts(3000)
    ids, n = tokenizer.encode(texts)
    ends = np.cumsum(n)
    for text, a, b, want in zip(texts, ends - n, ends, lib.encode_batch(texts, add_special_tokens=False)):
        assert ids[a:b].tolist() == want.ids, text


def test_words_cut_by_bytes_equal_the_library():
    import pyarrow as pa

    tokenizer, lib = packing.WordTokenizer(public_tokenizers.path(packing.TOKENIZER)), library(packing.TOKENIZER)
    rng = random.Random(4)
    signs = "aAbZ'strevlmdSTREVLMD019\u00b2\u00bc\u00aa\u00b5\u00df\u00d7\u00c0\u00de\u00fe\u00ff\u0100\u012e\u012f\u0130<|>.,-#\x1c\x85\xa0\t\n  \u6f22"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(1500)] + ["".join(rng.choices("'stremvld s't", k=20)) for _ in range(1500)]
    texts += [None, "", "it's 'tis we've''s"] + [f"a{chr(c)}b {chr(c)} 1{chr(c)}'{chr(c)}s" for c in range(0x140)] + odd_texts(500)
    ids, n = tokenizer.encode_column(pa.array(texts))
    ends = np.cumsum(n)
    for text, a, b, want in zip(texts, ends - n, ends, lib.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids[a:b].tolist() == want.ids, text
    tokenizer.words = packing.WordIds(30)
    for text in texts[:300]:
        ids, _ = tokenizer.encode_column(pa.array([text, text]))
        assert ids.tolist() == 2 * lib.encode(text or "", add_special_tokens=False).ids and tokenizer.words.n <= 40


def test_index_scores_are_bm25():
    rng = np.random.default_rng(0)
    lengths = rng.integers(3, 30, 12)
    ids = rng.integers(0, 40, lengths.sum()).astype(np.uint16)
    docs = np.split(ids, np.cumsum(lengths)[:-1])
    df = np.array([sum(t in d for d in docs) for t in range(65536)])
    idf = np.log1p((12 - df + 0.5) / (df + 0.5))
    index = packing.Index(ids, lengths, idf, lengths.mean())
    for q in range(12):
        want = [sum(idf[t] * (tf := (d == t).sum()) * 2.2 / (tf + 1.2 * (0.25 + 0.75 * d.size / lengths.mean())) for t in np.unique(docs[q]) if (d == t).any()) for d in docs]
        assert np.allclose(index.scores(q), want)


def test_windows_take_the_best_unused_neighbours():
    lengths = np.array([5, 5, 5, 5, 23, 2])
    score = np.eye(6)[[0, 1, 2, 3, 4, 5]] * 9
    score[0, 3], score[0, 1], score[3, 2] = 5, 4, 3
    out = packing.pack_shard(lengths, lambda q: score[q].copy(), 10)
    # two whole windows of document 4, then 0 with its best neighbour 3; 1 is seeded next
    assert out[:3] == [[(4, 0, 10)], [(4, 10, 10)], [(0, 0, 5), (3, 0, 5)]]
    assert sorted(d for own in out for d, a, n in own for _ in range(n)) == sorted(np.repeat(np.arange(6), lengths))
    assert all(sum(n for *_, n in own) in (1, 2, 4, 8, 10) for own in out)


def vocabulary_words(n):
    known = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)).get_vocab()
    plain = sorted(w.removesuffix("</w>") for w in known if re.fullmatch("[a-z]{4,}(</w>)?", w))
    lib = library(packing.TOKENIZER)
    random.Random(9).shuffle(plain)
    return [w for w in dict.fromkeys(plain) if len(lib.encode(w, add_special_tokens=False).ids) == 1][:n]


def test_neighbours_meet_wherever_they_were_read(session):
    rng, pairs = random.Random(7), 800
    vocabulary = vocabulary_words(3 * pairs + 60)
    common, own = vocabulary[:60], [vocabulary[60 + 3 * i : 63 + 3 * i] for i in range(pairs)]
    text = lambda i: " ".join(rng.sample(own[i] + rng.choices(common, k=50), 53))
    rows = [(i, text(i)) for i in range(pairs)] + [(pairs + i, text(i)) for i in range(pairs)]
    pieces = packing.pack(frame(session, rows), window=112, shard_docs=64).collect()
    where = {}
    for r in pieces:
        where.setdefault(r["doc_id"], set()).add(r["sequence_id"])
    met = sum(bool(where[i] & where[pairs + i]) for i in range(pairs))
    assert met >= 0.9 * pairs
    # brute force: the partner is the best neighbour of each of these documents
    assert sum(r["length"] for r in pieces) == 54 * 2 * pairs


def test_a_hot_key_is_split(session):
    rows = [(i, "same few words in each copy") for i in range(300)] + [(1000 + i, f"other {i}") for i in range(50)]
    table = packing.blocks(frame(session, rows), public_tokenizers.path(packing.TOKENIZER)).persist()
    place = packing.rarity(packing.corpus_statistics(table)[0])
    got = packing.dealt(table, place, *packing.shard_plan(table, place, 64, 2_000_000)).groupBy("shard").count().collect()
    assert sum(r["count"] for r in got) == len(rows) and max(r["count"] for r in got) <= 2 * 64
    table.unpersist()


def test_packing_query_wastes_nothing(session):
    rows = [tuple(r) for r in session.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    pieces = packing.op2_packing(session, SMALL).collect()
    lib = library(packing.TOKENIZER)
    assert sum(r["length"] for r in pieces) == sum(len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)


# HTML


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


WEIGHTS = {"#word": 1.0, html_extract.LEFT_OUT: -0.02, "p": -0.02, "/p": -0.02, "h1": -0.02, "/h1": -0.02, "div": -2.0, "/div": -2.0, "article": -3.0, "/article": -3.0, "ul": -4.0, "li": -3.0, "a": -2.0, "/a": -2.0}


@pytest.mark.parametrize("body,want", [
    ("<nav><a href='/x'>menu here</a></nav><article><h1>A  title</h1><p>One\n two<br>three</p></article><footer>end</footer>", "A title\nOne two\nthree"),
    ("<article><p>x &amp; y &lt;b&gt; &copy; &#233;</p></article>", "x & y <b> © é"),
    ("<article><p>text</p><section class='comments'><p>a reader says a lot of things here</p></section><p>more</p></article>", "text\nmore"),
    ("<div id=cookie-notice>we use cookies a lot</div><article><p>only this</p></article><aside>see also this</aside>", "only this"),
    ("<article><p>a<script>var x='</p><p>no';</script>b</p><form><input>name</form></article>", "ab"),
    ("<article><p>open <b>bold<p>next <!-- <p>hidden</p> --> line", "open bold\nnext line"),
    ("<nav>never closed <article><p>inside</p></article>", "inside"),
    ("<header>top words of the page</header><main><p>m</p></main>", "m"),
    ("<article><p></p><p>   </p></article>", ""),
    # names that only begin like a raw element
    ("<article><svg-icon></svg-icon><title-bar>t</title-bar><p>one</p><style-guide>s</style-guide><svg/><p>two</p></article>", "t\none\ns\ntwo"),
    # names that tell of the layout or of something else than a part of the page
    ("<div class='layout with-sidebar'><div class='post no-comments'><p>all of these words</p></div></div>", "all of these words"),
    ("<article><div class='entry-header'><h1>Head of the whole page</h1></div><p class='notice-of-motion'>it was moved</p><div id=header>four words on top</div></article>", "Head of the whole page\nit was moved\nfour words on top"),
    ("<article><p>a</p><div class='commentList'>c</div><div class='left-sidebar'>s</div><div class='x ad-slot-3'>ad</div><p>b</p></article>", "a\nb"),
    # left-out inline elements end no block
    ("<article><p>before <button>click</button>and <span class='share'>share</span>after <svg><path/></svg>end</p></article>", "before and after end"),
    ("", ""),
])
def test_main_text_of_pages(body, want):
    assert html_extract.extract(page(body), WEIGHTS) == want


def test_every_class_word_is_a_feature_of_its_tag():
    weights = {**WEIGHTS, "div.zebra": -8.0, "div.alpha": -0.1}
    assert html_extract.weight_of("div.alpha.beta.zebra", weights) == -8.0
    assert html_extract.weight_of("div.alpha.beta", weights) == -0.1
    assert html_extract.weight_of("div.beta", weights) == weights["div"]
    assert html_extract.weight_of("new.beta", weights) == html_extract.TAG_UNKNOWN
    body = "<div class='zebra alpha beta'>two words</div><p>four words of text</p>"
    assert html_extract.extract(page(body), weights) == "four words of text"


def test_best_region_is_the_maximum_sum():
    rng = random.Random(0)
    for _ in range(300):
        w = [rng.randint(-5, 5) for _ in range(rng.randint(0, 12))]
        a, b = html_extract.best_region(w)
        assert sum(w[a:b]) == max([0] + [sum(w[i:j]) for i in range(len(w)) for j in range(i + 1, len(w) + 1)])


def test_pages_without_marks_use_learned_weights(session):
    article = [page(f"<div><a href=x>menu {i}</a><a href=y>more</a></div><article><p>{'word ' * 30}{i}</p><p>{'text ' * 20}</p></article><div><a href=z>foot</a></div>") for i in range(20)]
    plain = page(f"<div><a href=x>menu</a><a href=y>more</a></div><p>{'word ' * 30}</p><p>{'text ' * 20}</p><div><a href=z>foot</a></div>")
    rows = session.createDataFrame([(i, "u", x, "extra") for i, x in enumerate([*article, plain, None, "", "plain text only"])], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html_extract.main_text(rows, html_extract.fit(rows)).collect()}
    assert got[20]["text"] == ("word " * 30).strip() + "\n" + ("text " * 20).strip()
    assert got[21]["text"] == got[22]["text"] == "" and got[23]["text"] == "plain text only"
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_extraction_query_gives_the_articles(session):
    pages = session.read.parquet(f"{MEDIUM}/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in html_extract.op1_html_extract(session, MEDIUM).collect()}
    assert len(got) == len(pages)
    for r in pages:
        inner = r["html"][r["html"].index("<article>") + 9 : r["html"].index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:h1|p|br)>", inner))
        assert got[r["page_id"]] == "\n".join(filter(None, blocks))
    empty = session.read.parquet(f"{MEDIUM}/pages.parquet").limit(0)
    assert html_extract.main_text(empty, html_extract.fit(empty)).count() == 0


# WARC


def page_rows():
    big = "<p>" + "payload " * 300
    return [(1, "http://a/1", big), (2, "http://a/2?q=ä b", big), (3, None, "small"), (4, "http://a/4", "small"), (5, "http://a/5", None),
            (6, "http://a/6", ""), (7, "http://a/7", "é" * 600), (8, "http://a/8\nX: y", "é" * 600), (9, "u", "x" * 999), (10, "u", "x" * 999),
            (11, "u", "x" * 1000), (12, "u", "x" * 1000), (12, "u", "x" * 1000), (None, "u", big), (13, "u", "long " * 400_000)]


def test_warc_cases_match_sql_and_round_trip(session):
    rows = page_rows()
    pages = session.createDataFrame([(*r, "other") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    folder = scratch_path(session, "warc-test")
    index = warc.write_archives(warc.plan_records(pages), folder)
    got = warc.read_archives(index, folder).collect()
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": pa.array([r[0] for r in rows], pa.int64()), "html": pa.array([r[2] for r in rows], pa.string())}))
    want = [r if r[0] is not None else (None, r[1], r[2], "revisit", 2) for r in con.sql(warc.SQL).fetchall()]
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert (r["page_id"], r["url"]) in {(i, u) for i, u, _ in rows}
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() in {h or "" for i, _, h in rows if i == r["page_id"]}
    # a selection reads only its records; every file is a plain series of gzip members
    some = warc.read_archives(index.where("page_id in (3, 9)"), folder).collect()
    assert sorted(r["page_id"] for r in some) == [3, 9]
    store, path = warc.file_system(folder)
    for r in index.select("file").distinct().collect():
        data = gzip.decompress(store.open_input_file(f"{path}/{r['file']}").read())
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")


def test_ranges_coalesce_neighbours():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 5), ("b", 0, 5), ("b", 5, 50)]
    got = [(f, x, y, len(m)) for f, x, y, m in warc.ranges(rows, most=40, gap=6)]
    assert got == [("a", 0, 30, 3), ("a", 100, 105, 1), ("b", 0, 5, 1), ("b", 5, 55, 1)]


def test_warc_query_and_empty_table(session):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    assert sorted(map(tuple, warc.op7_warc(session, SMALL).collect())) == sorted(con.sql(warc.SQL).fetchall())
    folder = scratch_path(session, "warc-test")
    empty = session.read.parquet(f"{SMALL}/pages.parquet").limit(0)
    assert warc.read_archives(warc.write_archives(warc.plan_records(empty), folder), folder).count() == 0


# pipeline


def test_stages_do_what_their_operators_decide(session):
    docs = session.read.parquet(f"{SMALL}/documents.parquet")
    lab = session.read.parquet(f"{SMALL}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "exact_dedup", "near_dedup", "packing"]
    ids = lambda d: sorted(r["doc_id"] for r in d.select("doc_id").collect())
    kept = lambda d: sorted(r["doc_id"] for r in d.collect() if r["kept"])
    for (name, stage) in corpus_pipeline.STAGES[:-1]:
        out = stage(session, docs, SMALL)
        assert out.schema.fieldNames() == docs.schema.fieldNames()
        want = {
            "quality_rules": lambda: kept(quality.quality_rules(docs, quality.fit(docs, lab))),
            "toxicity": lambda: sorted(r["doc_id"] for r in toxicity.toxicity(docs, toxicity.fit(docs, lab)).collect() if not r["predicted"]),
            "exact_dedup": lambda: kept(exact_dedup.exact_dedup(docs)),
            "near_dedup": lambda: kept(near_dedup.near_duplicates(docs)),
        }[name]()
        assert ids(out) == want, name
        docs = session.createDataFrame(out.toPandas(), docs.schema)
    pieces = corpus_pipeline.run(session, SMALL).collect()
    assert sorted({r["doc_id"] for r in pieces}) == ids(docs)
    lib = library(packing.TOKENIZER)
    assert sum(r["length"] for r in pieces) == sum(len(lib.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect())


def test_stages_on_cases_and_empty_tables(session, tmp_path):
    rows = documents()
    labels(session, rows).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (frame(session, rows), frame(session, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(session, docs, str(tmp_path))
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](session, docs, str(tmp_path)).count() >= docs.count()
