import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import MEDIUM, SMALL, documents, fold, frame, lower, session, words  # noqa: F401

from plinth.llm import queries, runs, url_rules, variants

PAGES = "page_id long, url string, host string, tokens string, size string, rule string, verdict string, item string, rows string, confidence string"


def brute_runs(w):
    out = []
    for q in range(1, len(w) // runs.TIMES + 1):
        at = 0
        while at + q < len(w):
            start = at
            while at + q < len(w) and w[at] == w[at + q]:
                at += 1
            n = at - start + q
            own = w[start : start + n]
            if n >= max(runs.LEAST, runs.TIMES * q) and not any(all(own[i] == own[i + d] for i in range(n - d)) for d in range(1, q)):
                out.append((start, n, q))
            at = max(at, start + 1) if at == start else at
    return sorted(out)


def brute_collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def repeated(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_runs_against_brute_force():
    rng = random.Random(1)
    texts = []
    for _ in range(600):
        w = [b"abc"[k : k + 1] for k in rng.choices(range(rng.choice([1, 2, 2, 3])), k=rng.randint(0, 110))]
        if w and rng.random() < 0.6:
            a, p = rng.randrange(len(w)), rng.randint(1, 15)
            w = w[:a] + (w[a : a + p] * len(w))[: len(w) - a]
        texts.append(w)
    want = [brute_runs(t) for t in texts]
    assert runs.runs_of_texts(texts) == want and sum(map(len, want)) > 300
    assert {q for own in want for _, _, q in own} >= set(range(1, 12))
    assert [runs.runs_of([x[0] for x in t]) for t in texts] == want
    long = [b"%d" % rng.randrange(900) for _ in range(1_000)] * 5
    assert runs.runs_of_texts([long, long[:7], [b"x"] * 20_000]) == [[(0, 5_000, 1_000)], [], [(0, 20_000, 1)]]


def test_stretches_hold_every_run_whatever_the_neighbours():
    rng = random.Random(3)
    for _ in range(100):
        texts = [[b"ab"[k : k + 1] for k in rng.choices((0, 1), k=rng.randint(0, 40))] for _ in range(6)]
        assert runs.runs_of_texts(texts) == [brute_runs(t) for t in texts]


def check_run_rows(got, rows):
    assert len(got) == len(rows)
    have, want = Counter(map(tuple, got)), Counter()
    for doc_id, text in rows:
        w = repeated(doc_id, words(text))
        found = brute_runs(w)
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want[doc_id, len(found), *top, None if top[0] is None else 1000 * top[1] // top[2],
             sha("".join("%d,%d,%d\n" % r for r in found)), sha(brute_collapsed(w, found))] += 1
    assert have == want
    return sum(n for key, n in want.items() if key[1])


def test_periodic_runs_query_and_cases(session, tmp_path):
    rows = documents() + [(i, "one two three four " * 5 + "end") for i in range(200, 260)] + [(300, "a b " * 3 + "c c c c c c c d"), (301, "Ä ä Ä ä Ä ä Ä ä")]
    rows = [(i, t if len(t or "") < 100_000 else t[:40_000]) for i, t in rows]
    frame(session, rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert check_run_rows(queries.QUERIES["op12_periodic_runs"](session, str(tmp_path)).collect(), rows) > 60
    real = session.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    real = [tuple(r) for r in real if len(r["text"] or "") < 12_000]
    assert check_run_rows([r for r in queries.QUERIES["op12_periodic_runs"](session, SMALL).collect() if r["doc_id"] in {i for i, _ in real}], real)
    empty = queries.runs.find_runs(frame(session, rows).limit(0))
    assert empty.columns == ["doc_id", "runs", "collapsed"] and not empty.collect()


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len, reverse=True)
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def test_composition_against_brute_force():
    rng = random.Random(2)
    for k in range(120):
        have = sorted({"".join(rng.choices("ab" if k % 2 else "abcé", k=rng.randint(1, 7))) for _ in range(rng.randint(0, 60))})
        got = list(variants.OneEdit(variants.Acceptor(have)).pairs())
        assert Counter(map(frozenset, got)) == Counter(frozenset(p) for p in itertools.combinations(have, 2) if near(*p))
    long = ["x" * 30_000 + c for c in "abc"] + ["x" * 30_000]
    assert len(list(variants.OneEdit(variants.Acceptor(sorted(long))).pairs())) == 6
    shared = variants.Acceptor(sorted(a + b for a in ("walk", "talk", "link") for b in ("", "ed", "ing")))
    assert len(shared.arcs) < 16


def brute_variants(rows, lost):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if lost and doc_id is not None and h % lost == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    by_hole = {}
    for w in count:
        for i in range(len(w)):
            by_hole.setdefault((i, w[:i] + w[i + 1 :]), set()).add(w)
    close = {w: set() for w in count}
    for (_, rest), own in by_hole.items():
        for w in own:
            close[w] |= own - {w}
            if rest in count:
                close[w].add(rest)
                close[rest].add(w)
    form = {}
    for w, own in close.items():
        best = min(own, key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None
    out = set()
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, count[w], len(close[w]), count.get(form[w])))
    return out


@pytest.mark.parametrize("most", [variants.WORDS, 40])
def test_spelling_variants_cases(session, most):
    rng = random.Random(4)
    stems = ["".join(rng.choices("abcdeé", k=rng.randint(4, 7))) for _ in range(60)]
    typo = lambda w: (lambda i: w[:i] + rng.choice(["", "x", "bb"]) + w[i + 1 :])(rng.randrange(len(w)))
    rows = [(i, " ".join(typo(s) if rng.random() < 0.3 else s for s in rng.choices(stems, k=80))) for i in range(80)]
    rows += [(90, None), (91, ""), (None, "Naïve naïve NAÏVE naïv\u00ef × ÷÷÷÷÷ ÷÷÷÷÷ ÷÷÷÷÷"), (92, "straße-straße’straße 漢字straße"), (93, "y" * 2_000 + " ")] * 3
    rows += [(0, rows[0][1]), (94, "aaaaab aaaaab aaaaab aaaab aaaab aaaab aaaa aaaa aaaa")] * 2
    got = variants.spelling_variants(frame(session, rows), lost=7, most=most)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(rows, 7)
    have = [tuple(r) for r in got.collect()]
    assert len(have) == len(set(have)) and set(have) == want and sum(1 for r in want if r[1]) > 50
    assert not variants.spelling_variants(frame(session, rows).limit(0)).collect()


def test_spelling_variants_query(session):
    docs = [tuple(r) for r in session.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in queries.QUERIES["op13_spelling_variants"](session, MEDIUM).collect()} == brute_variants(docs, 97)


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    return lower(host), re.match("[^?#]*", rest[len(host) :]).group()


def brute_given(host, path):
    fits = [(h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def brute_tokens(url):
    host, path = brute_host_path(url)
    labels = [x for x in host.split(".") if x]
    out = ["h:" + x for x in labels] + ["w:" + y for x in labels if "-" in x for y in x.split("-") if y]
    out += ["p:" + re.sub("[0-9]+", "0", x) for x in path.split("/") if x]
    if m := re.search(r"\.([A-Za-z0-9]+)$", path):
        out.append("e:" + m[1])
    if m := re.search(r"://[^?#]*\?([^#]*)", url or "", re.DOTALL):
        out += ["q:" + k for x in m[1].split("&") if (k := x.split("=")[0])]
    return frozenset(out)


def brute_blocked(labelled, urls):
    """The most confident rule of every URL by all subsets of tokens."""
    rows = [(brute_tokens(u), v) for u, v in labelled]
    least = max(url_rules.SUPPORT * len(rows), url_rules.LEAST_ROWS)
    once = Counter(t for tokens, _ in rows for t in tokens)
    used = {t for t, n in once.items() if n >= least - 1e-9}
    every, bad = Counter(), Counter()
    for tokens, v in rows:
        own = sorted(tokens & used)
        for n in range(1, len(own) + 1):
            for some in itertools.combinations(own, n):
                every[frozenset(some)] += 1
                bad[frozenset(some)] += v == "block"
    base = sum(v == "block" for _, v in rows) / max(len(rows), 1)
    good = {s: bad[s] / n for s, n in every.items() if bad[s] >= least - 1e-9 and bad[s] / n >= url_rules.CONFIDENCE and bad[s] / n / base > url_rules.LIFT}
    return [max((c for s, c in good.items() if s <= brute_tokens(u)), default=None) for u in urls]


def page_rows():
    rng = random.Random(6)
    out = [None, "", "no scheme/x", "http://", "HTTP://EXAMPLE.ORG/es/1", "https://x.org", "http://a.org?x=/es/", "ftp://notexample.org/es/2", "a://b://c.com/fr/1",
           "http://example.org/en/1", "http://EXAMPLE.org/en/2", "http://a.example.org/en/100#top", "http://com/de/", "http://x.net/a\nb?q=1&r&=2#z", "://net", "http://É.com/fr/é"]
    for i in range(300):
        host = rng.choice(["www", "m", "cheap-pills", "news"]) + "." + rng.choice(["one", "two"]) + "." + rng.choice(["com", "org", "net"])
        out.append(f"http://{host}/{rng.choice(['en', 'de', 'fr', 'es'])}/{i}" + rng.choice(["", "?ref=a", "?utm=1&page=2", ".html"]))
    out += ["http://hot.net/" + "/".join(f"k{j}" for j in range(40)) + "/x"] * 150
    return [(i if i % 9 else None, u) for i, u in enumerate(out)] + [(5, out[4])] * 2


def pages(session, rows):
    return session.createDataFrame([(i, u, *["other"] * 8) for i, u in rows], PAGES).repartition(3)


def test_url_rules_against_brute_force(session):
    rows = page_rows()
    rng = random.Random(8)
    labelled = [(u, "block" if u and ("pills" in u and "/de/" not in u or "hot.net" in u and rng.random() < 0.8 or rng.random() < 0.1) else "allow") for _, u in rows if rng.random() < 0.6]
    got = url_rules.judge(pages(session, rows), session.createDataFrame(labelled, "url string, verdict string")).collect()
    assert len(got) == len(rows)
    # the 40 tokens that only the hot URL has are one item; brute force gets one of them
    short = lambda u: u if u is None or "hot.net" not in u else "http://hot.net/k1"
    confidence = brute_blocked([(short(u), v) for u, v in labelled], [short(u) for _, u in rows])
    want = Counter()
    for (i, u), c in zip(rows, confidence):
        host, path = brute_host_path(u)
        rule, verdict = brute_given(host, path)
        c = None if rule else c
        want[i, host, path, rule, verdict or ("allow" if c is None else "block"), None if c is None else round(c, 9)] += 1
    assert Counter((r[0], r[1], r[2], r[3], r[4], None if r[6] is None else round(r[6], 9)) for r in got) == want
    assert sum(r["mined_rule"] is not None for r in got) > 100
    for r in got:
        if r["mined_rule"]:
            assert set(r["mined_rule"].split(" ")) <= brute_tokens(next(u for _, u in rows if u and brute_host_path(u) == (r["host"], r["path"])))


def test_url_rules_query_and_edges(session):
    got = queries.QUERIES["op11_url_rules"](session, MEDIUM).collect()
    urls = {r["page_id"]: r["url"] for r in session.read.parquet(f"{MEDIUM}/pages.parquet").collect()}
    assert len(got) == len(urls) and {r["page_id"] for r in got} == set(urls)
    for r in got:
        host, path = brute_host_path(urls[r["page_id"]])
        rule, verdict = brute_given(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ({verdict} if verdict else {"allow", "block"})
    marks = session.createDataFrame([(17, 0, 0, "x"), (17, 1, 0, "x"), (18, None, 1, "x"), (19, 1, None, "x"), (20, None, None, "x"), (None, 0, 1, "x")],
                                    "doc_id long, quality int, toxic int, url string")
    known = url_rules.labelled_urls(pages(session, [(1, "http://a.net/17"), (2, "http://a.net/en/18.html?x=1"), (3, "http://a.net/19/"), (4, "http://a.net/20"), (5, "http://a.org/x"),
                                                    (6, None), (7, "http://a.net/" + "9" * 30)]), marks)
    assert sorted(map(tuple, known.collect())) == [("http://a.net/17", "block"), ("http://a.net/19/", "allow"), ("http://a.net/en/18.html?x=1", "block"), ("http://a.org/x", "allow")]
    none = session.createDataFrame([], "url string, verdict string")
    assert {r["verdict"] for r in url_rules.judge(pages(session, [(1, "http://a.net/x"), (2, None)]), none).collect()} == {"allow"}
    assert not url_rules.judge(pages(session, [(1, "u")]).limit(0), none).collect()
