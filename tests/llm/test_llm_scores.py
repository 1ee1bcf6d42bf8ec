import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import MEDIUM, SMALL, documents, fold, frame, labels, lower, session, words  # noqa: F401
from pyspark.sql import functions as F

from plinth.llm import ngram_lm, quality, resample, toxicity
from plinth.llm.elias_fano import EliasFano, Level, from_buffer, runs, to_bytes
from plinth.llm.text import BATCH_BYTES, releasing, releasing_group
from plinth.llm.transducer import Transducer, countdown


def brute_counts(text):
    w = words(text)
    win = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n, mark = Counter(win), [0] * len(w)
    for i, x in enumerate(win):
        if n[x] > 1:
            mark[i : i + 8] = [1] * 8
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * sum(mark) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, sum(mark), failed


def bucket(gram):
    h = 0
    for b in gram:
        h = (h * 0x01000193 % 2**32) ^ b
    return (h * 0x9E3779B1 % 2**32) >> (32 - quality.BITS)


def brute_ratio(rows, good):
    raw, target = Counter(), Counter()
    for i, t in rows:
        b = (t or "").encode()
        own = [bucket(b[k : k + 5]) for k in range(len(b) - 4)]
        raw.update(own)
        if i in good:
            target.update(own)
    n, m, prior = sum(raw.values()), sum(target.values()), quality.PRIOR * 2**quality.BITS
    return {k: math.log((target[k] + prior * c / n) / (m + prior) / (c / n)) for k, c in raw.items()}


def test_quality_cases_against_brute_force(session):
    rows = documents() + [(80, "same line here\nother\nsame line here\n\n\nsame line here"), (81, "a b c d e f g h " * 9)]
    docs, lab = frame(session, rows), labels(session, rows)
    got = quality.quality_rules(docs, quality.fit(docs, lab)).collect()
    assert len(got) == len(rows)
    ratio = brute_ratio(rows, {r["doc_id"] for r in lab.collect() if r["quality"] == 1 and r["doc_id"] is not None})
    want = []
    for i, t in rows:
        b = (t or "").encode()
        own = [ratio[bucket(b[k : k + 5])] for k in range(len(b) - 4)]
        score = sum(own) / len(own) if own else 0.0
        counts = brute_counts(t)
        want.append((i, *counts, round(score, 4), not counts[-1] and score >= quality.THRESHOLD))
    key = lambda r: str(r)
    assert sorted(((*r[:7], round(r["score"], 4), r["kept"]) for r in got), key=key) == sorted(want, key=key)


def test_quality_without_target_and_empty(session):
    rows = documents()
    none = session.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality_rules(frame(session, rows), quality.fit(frame(session, rows), none)).collect()
    assert all(r["kept"] == (not r["base_failed"]) and r["score"] == 0 for r in got)
    assert quality.quality_rules(frame(session, []), quality.fit(frame(session, []), none)).count() == 0


def test_quality_keeps_good_and_rejects_bad(session):
    lab = {r["doc_id"]: r["quality"] for r in session.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    got = [r for r in quality.op9_quality_rules(session, MEDIUM).collect() if r["doc_id"] in lab and not r["base_failed"]]
    good = [r["kept"] for r in got if lab[r["doc_id"]] == 1]
    bad = [r["kept"] for r in got if lab[r["doc_id"]] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.15


def test_composition_equals_running_in_turn():
    rng = random.Random(1)
    a = Transducer({0: {"Q": (1, "Q", 1.0)}, 1: {"I": (1, "I", 0.5)}})
    b = countdown("N", 2, "OINQ", {"I": ("I", 0.25)})
    both = a.compose(b, "OINQ")
    for _ in range(200):
        s = p = q = 0
        for x in rng.choices("OINQ", k=12):
            s, out, w = both.step(s, x)
            p, y, v1 = a.step(p, x)
            q, z, v2 = b.step(q, y)
            assert (out, w) == (z, v1 * v2)


def test_clause_weights_depend_on_the_clause():
    model = toxicity.Model(["idiot"], np.array([2.0, 3.0]), -3.0)
    score = lambda *t: model.score(__import__("pyarrow").array(list(t)))
    plain, you, negated, said, none, threat, verb = score(
        "what an idiot.", "you are an idiot.", "he talks. not an idiot.", "they wrote idiot.", "a fine day.", "i will hurt you. and you hurt", "they hurt")
    assert you > plain > negated > none and plain > said > none and threat > none
    assert np.allclose(score("what an idiot. fine", None, ""), [plain, none, none])
    assert score("not. an idiot")[0] == pytest.approx(plain)  # negation ends with its clause


def test_targets_before_and_after_their_hit():
    model = toxicity.Model(["idiot"], np.array([2.0, 3.0]), -3.0)
    score = lambda *t: model.score(__import__("pyarrow").array(list(t)))
    none, plain, targeted, threat = score("a fine day", "what an idiot", "you are an idiot", "they hurt")
    assert np.allclose(score("i will hurt you", "I will kill you!", "going to hurt him"), threat) and threat > none
    assert np.allclose(score("what an idiot you are", "idiot, that is you", "you idiot you"), targeted) and targeted > plain
    # too far, or in another clause
    assert np.allclose(score("hurt a b c d e you", "they said it. will hurt. you", "will hurt"), none)
    assert none < score("i will never hurt you")[0] < threat
    assert none < score("someone said i will hurt you")[0] < threat


def test_toxicity_cases(session):
    rows = documents() + [(90, "you idiot. " * 30), (91, "You IDIOT, stupid scum!")]
    docs, lab = frame(session, rows), labels(session, rows)
    got = toxicity.toxicity(docs, toxicity.fit(docs, lab)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[91]["predicted"] == 1 and by[1]["predicted"] == 0 and by[41]["score"] == by[40]["score"]
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in got if r["doc_id"] is not None)
    assert toxicity.toxicity(frame(session, []), toxicity.fit(frame(session, []), lab.limit(0))).count() == 0
    assert 91 not in {r["doc_id"] for r in toxicity.kept_documents(docs, toxicity.fit(docs, lab)).collect()}


def test_toxicity_learns_stems_and_generalises(session):
    rng = random.Random(2)
    text = lambda bad: " ".join(rng.choice(["grudum" + rng.choice("abcdef") + rng.choice("xyz")] if bad and rng.random() < 0.2 else [f"kolem{rng.randrange(300)}", f"pila{rng.randrange(300)}."]) for _ in range(60))
    rows = [(i, text(i % 8 == 0)) for i in range(600)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    lab = session.createDataFrame([(i, 1, int(i % 8 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, lab)
    assert any(s.startswith("grudum"[: len(s)]) or s.startswith("grudum") for s in model.lexicon.stems)
    got = [r for r in toxicity.toxicity(docs, model).collect() if r["held_out"]]
    assert len(got) > 50 and np.mean([r["predicted"] == (r["doc_id"] % 8 == 0) for r in got]) > 0.97


def test_toxicity_held_out_accuracy(session):
    lab = {r["doc_id"]: r["toxic"] for r in session.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    got = [r for r in toxicity.op10_toxicity(session, MEDIUM).collect() if r["held_out"] and r["doc_id"] in lab]
    assert np.mean([r["predicted"] == lab[r["doc_id"]] for r in got]) > 0.9


def test_resampling_against_brute_force(session):
    rows = documents()
    docs, lab = frame(session, rows), labels(session, rows)
    ratio = resample.fit(docs, lab)
    got = resample.resample(docs, ratio, 0.4).collect()
    assert len(got) == len(rows)
    top = sorted((r["gumbel_key"] for r in got), reverse=True)[: round(0.4 * len(rows))]
    assert all(r["kept"] == (r["gumbel_key"] >= top[-1]) for r in got)
    for r in got:
        text = next(t for i, t in rows if i == r["doc_id"])
        if r["doc_id"] is not None:
            assert r["n_grams"] == max(2 * len(words(text)) - 1, 0)
    assert {r["doc_id"]: r["log_weight"] for r in got}[41] == 0
    assert sorted(map(str, got)) == sorted(map(str, resample.resample(docs, ratio, 0.4).collect()))
    assert resample.resample(frame(session, []), ratio, 0.4).count() == 0
    assert not any(r["kept"] for r in resample.resample(docs, ratio, 0.0).collect())


def test_gumbel_top_k_draws_in_proportion_to_the_weights():
    import pyarrow as pa

    # two documents with weights 3 and 1: the first is drawn first in three quarters of the seeds
    first = [np.argmax(resample.gumbel(pa.array([1, 2]), s) + np.log([3.0, 1.0])) == 0 for s in range(4000)]
    assert abs(np.mean(first) - 0.75) < 0.03


def test_kth_largest(session):
    rng = random.Random(4)
    values = [rng.choice([-1, 1]) * rng.getrandbits(rng.choice([3, 20, 40, 62])) for _ in range(500)]
    rows = session.createDataFrame([(v,) for v in values], "x long")
    want = sorted(values, reverse=True)
    for k in (1, 2, 250, 499, 500):
        assert resample.kth_largest(rows, "x", k) == want[k - 1]
    assert resample.kth_largest(rows, "x", 0) is None and resample.kth_largest(rows, "x", 501) is None


def test_resampling_prefers_good_documents(session):
    lab = {r["doc_id"]: r["quality"] for r in session.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    got = [r for r in resample.op8_importance_resampling(session, MEDIUM).collect() if r["doc_id"] in lab]
    mean = lambda q: np.mean([r["kept"] for r in got if lab[r["doc_id"]] == q])
    assert mean(1) > mean(0) + 0.25


def test_elias_fano_get_and_successor():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1), (1, 10**12), (1000, 50), (5000, 10**6), (777, 10**14)):
        values = np.sort(rng.integers(0, top, n))
        ef = EliasFano.load(from_buffer(np.frombuffer(to_bytes(EliasFano.build(values)), np.uint8)))
        assert np.array_equal(ef.get(np.arange(n)), values)
        asked = rng.integers(0, top + 2, 500)
        assert np.array_equal(ef.successor(asked), np.searchsorted(values, asked, "left"))


def test_elias_fano_reads_no_low_bits_outside_a_bucket():
    rng = np.random.default_rng(2)
    values = np.sort(np.concatenate([rng.integers(0, 10**9, 4000), np.full(3000, 77), 500 + np.arange(2000)]))
    seq = EliasFano.load([x.view(np.uint8) for x in EliasFano.build(values)])
    asked, low = np.concatenate([values, rng.integers(0, 2 * 10**9, 4000), [0, 2**40]]), []
    plain = seq._low
    seq._low = lambda i: low.append(i.size) or plain(i)
    assert (seq.successor(asked) == np.searchsorted(values, asked)).all()
    assert (seq.bucket[1:-1] == np.searchsorted(seq.upper, np.arange(seq.bucket.size - 2), "right")).all()
    own, run = runs(np.array([3, 3, 1, 3, 3, 3]))
    assert own.tolist() == [3, 1, 3] and run.tolist() == [2, 1, 3]
    assert max(low) < asked.size


def test_trie_level_finds_children_of_their_context_only():
    first, ids = np.array([0, 2, 3, 6]), np.array([4, 9, 4, 1, 4, 100])
    level = Level(Level.build(first, ids, np.log10(np.linspace(0.1, 0.6, 6))))
    place, rank = level.find(np.array([0, 0, 1, 1, 2, 2, -1, 2]), np.array([4, 100, 4, 9, 100, 9, 4, 1]))
    assert place.tolist() == [0, -1, 2, -1, 5, -1, -1, 3] and rank.tolist() == [0, -1, 0, -1, 2, -1, -1, 0]


def brute_lm(rows):
    texts = [(i, i is not None and fold(i, 10) == 0, [*words(lower(t)), "\0"]) for i, t in rows]
    one, two, three = Counter(), Counter(), Counter()
    for _, held, w in texts:
        if not held:
            x = ["\1", "\1", *w]
            one.update(w)
            two.update(zip(x[1:], x[2:]))
            three.update(zip(x, x[1:], x[2:]))
    n, v = sum(one.values()), len(one)
    once, twice = (sum(c == k for c in one.values()) for k in (1, 2))
    d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
    total, kinds = Counter(), Counter()
    for gram, c in [*two.items(), *three.items()]:
        total[gram[:-1]] += c
        kinds[gram[:-1]] += 1

    def chance(u, x, w):
        p = (one[w] - d if one[w] else d * v) / n if n else 1.0
        for gram, cut, table in (((x,), 0.75, two), ((u, x), 0.9, three)):
            if total[gram]:
                p = (max(table[(*gram, w)] - cut, 0) + cut * kinds[gram] * p) / total[gram]
        return p

    out = []
    for i, held, w in texts:
        x = ["\1", "\1", *w]
        score = sum(math.log10(chance(*x[k : k + 3])) for k in range(len(w)))
        base = sum(math.log10((one[y] + 0.1) / (n + 0.1 * (v + 1))) for y in w)
        out.append((i, held, len(w), sum(one[y] > 0 for y in w), n, base, score))
    return out, sum(chance("\1", "\1", y) for y in [*one, "\2"]) if n else 1.0


@pytest.mark.parametrize("shard,block", [(2_000_000, 1_000_000), (3_000, 1_500)])
def test_language_model_against_brute_force(session, monkeypatch, shard, block):
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", shard)
    monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", block)
    rows = documents()
    want, mass = brute_lm(rows)
    assert abs(mass - 1) < 1e-9
    got = ngram_lm.score_documents(frame(session, rows)).collect()
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6)
        assert abs(a[6] - b[6]) <= 0.08 * b[2] + 0.05, (a, b)  # 8-bit probabilities


@pytest.mark.parametrize("shard,groups", [(1_200, 3), (600, 8)])
def test_language_model_in_groups_of_shards_against_brute_force(session, monkeypatch, shard, groups):
    rng = random.Random(12)
    common = ["the", "of", *"abcdefghij"]
    rows = documents() + [(5_000 + i, " ".join(rng.choice(common[: 1 + rng.randrange(12)]) if rng.random() < 0.7 else f"z{rng.randrange(300)}"
                                               for _ in range(rng.randint(0, 30)))) for i in range(600)]
    for name, value in (("SHARD_TOKENS", shard), ("BLOCK_TOKENS", 900), ("GROUPS", groups), ("GROUP_SHARDS", 4), ("PART_SHARDS", 3), ("WIDE_PAIRS", 500)):
        monkeypatch.setattr(ngram_lm, name, value, raising=False)
    want, _ = brute_lm(rows)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got = ngram_lm.score_documents(frame(session, rows)).collect()
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6)
        assert abs(a[6] - b[6]) <= 0.08 * b[2] + 0.05, (a, b)  # 8-bit probabilities


def test_language_model_messages_do_not_multiply_with_the_shards(session):
    rng = random.Random(9)
    docs = session.createDataFrame([(i, " ".join(f"y{int(rng.paretovariate(0.5)) % 3000}" for _ in range(300))) for i in range(150)], "doc_id long, text string")
    table = ngram_lm.blocks(docs.coalesce(1))
    (block,) = table.collect()
    sizes = []
    for shards in (8, 1024):
        words_of = ngram_lm.Unigrams(3000, block["tokens"], 100, 100, block["train_docs"], shards)
        rows = ngram_lm.requests(table, ngram_lm.word_counts(table, 2), words_of).where("kind = 0").collect()
        columns = [ngram_lm._unsqueeze(bytes(r["body"])) for r in rows]
        assert 0.98 * block["tokens"] < sum(c[0].size for c in columns) <= block["tokens"]  # not those after an unknown word
        sizes.append((len(rows), sum(x.size for c in columns for x in c)))
    assert sizes[1][0] <= 256 and sizes[1][1] < 1.5 * sizes[0][1]


def test_words_of_64_bit_hashes_get_their_places():
    rng = np.random.default_rng(4)
    for hashes in (rng.integers(0, 2**64, 5000, dtype=np.uint64), rng.integers(0, 2**64, 40, dtype=np.uint64)[rng.integers(0, 40, 3000)],
                   np.uint64(7) << np.uint64(40) | rng.integers(0, 9, 500, dtype=np.uint64), np.empty(0, np.uint64)):
        for got, want in zip(ngram_lm._placed_hashes(hashes), np.unique(hashes, return_inverse=True)):
            assert np.array_equal(got, want)
    for values in (rng.integers(0, 2**62, 900), rng.integers(0, 50, 900), np.empty(0, np.int64)):
        for got, want in zip(ngram_lm._placed(values), np.unique(values, return_inverse=True)):
            assert np.array_equal(got, want)


def test_language_model_splits_the_start_of_texts(session, monkeypatch):
    rng = random.Random(6)
    rows = [(i, " ".join([rng.choice(["the", "the", "a", f"x{i % 40}"]), *rng.choices("abcdefgh", k=rng.randint(0, 3))])) for i in range(900)]
    docs = session.createDataFrame(rows, "doc_id long, text string").repartition(3)
    table = ngram_lm.blocks(docs)
    tokens = table.groupBy().sum("tokens").first()[0]
    words_of = ngram_lm.Unigrams(60, tokens, 10, 10, 810, 10)
    got = ngram_lm.requests(table, ngram_lm.word_counts(table, 10), words_of).where("kind = 0").select("shard", "body").collect()
    starts = Counter()
    for r in got:
        starts[r["shard"]] += int((np.cumsum(ngram_lm._unsqueeze(bytes(r["body"]))[0]) >> ngram_lm._PARTS == ngram_lm._START).sum())
    assert sum(starts.values()) == 900 and max(starts.values()) < 600
    # the same scores as in one shard, also with every part smaller than the start
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", tokens // 10)
    monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", 1000)
    key = lambda r: r[0]
    for a, b in zip(sorted(map(tuple, ngram_lm.score_documents(docs).collect()), key=key), sorted(brute_lm(rows)[0], key=key)):
        assert a[:5] == b[:5] and abs(a[6] - b[6]) <= 0.08 * b[2] + 0.05, (a, b)


def test_language_model_without_rows_or_training(session):
    assert ngram_lm.score_documents(frame(session, [])).count() == 0
    held = next(i for i in range(100) if fold(i, 10) == 0)
    (got,) = ngram_lm.score_documents(frame(session, [(held, "a b")])).collect()
    assert tuple(got) == (held, True, 3, 0, 0, 0.0, 0.0)


def test_language_model_keeps_its_files(session, tmp_path):
    docs = session.read.parquet(f"{SMALL}/documents.parquet")
    ngram_lm.score_documents(docs, f"file://{tmp_path}").count()
    (file,) = tmp_path.iterdir()
    from pyarrow import fs

    trie = ngram_lm.open_trie(fs.LocalFileSystem(), str(file))
    assert trie.names.n > 1000 and trie.triples.ids.n > trie.words.ids.n


def test_language_model_beats_the_base_on_held_out_text(session):
    got = [r for r in ngram_lm.op4_ngram_lm(session, MEDIUM).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > 0.75 * sum(r["base_score"] for r in got)


def test_language_model_sends_a_word_and_its_probability_once_a_message(session):
    rng = random.Random(8)
    docs = session.createDataFrame([(i, " ".join(f"y{int(rng.paretovariate(0.7)) % 5000}" for _ in range(400))) for i in range(100)], "doc_id long, text string")
    table = ngram_lm.blocks(docs.coalesce(1))
    (block,) = table.collect()
    hashes = ngram_lm._unsqueeze_sorted(bytes(block["words"]))
    assert (np.diff(hashes) > 0).all() and len(block["words"]) < 7.5 * hashes.size
    words_of = ngram_lm.Unigrams(5000, block["tokens"], 100, 100, block["train_docs"], 3)
    for r in ngram_lm.requests(table, ngram_lm.word_counts(table, 3), words_of).where("kind = 0").select("body").collect():
        word, code = ngram_lm._unsqueeze(bytes(r["body"]))[2:4]
        assert code.size == np.unique(word).size < word.size


def test_batches_of_documents_are_bounded_by_bytes(session):
    docs = session.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long").collect()
    assert sum(r["n"] for r in sizes) >= 30_000_000 and max(r["n"] for r in sizes) <= BATCH_BYTES + 200_000


def test_a_task_gives_freed_memory_back():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def rows(batches):
        held = [np.ones(1 << 12) for _ in range(8_000)]  # 32 kB each, so not mapped on their own
        last = np.ones(1 << 12)
        yield from batches
        seen.append(resident())
        del held
        kept.append(last)

    seen, kept, before = [], [], resident()
    assert list(releasing(rows)(iter([1, 2]))) == [1, 2]
    assert seen[0] - before > 200_000_000 and resident() - before < 60_000_000


def test_a_group_gives_freed_memory_back():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def rows(group):
        held = [np.ones(1 << 12) for _ in range(8_000)]  # 32 kB each, so not mapped on their own
        kept.append(np.ones(1 << 12))
        seen.append(resident())
        return group if len(held) else None

    seen, kept, before = [], [], resident()
    assert releasing_group(rows)("group") == "group"
    assert seen[0] - before > 200_000_000 and resident() - before < 60_000_000
