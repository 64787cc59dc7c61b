"""Operators with one right answer, against plain versions."""

import math
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewarden.llm import jaccard, packing, quality, substring, url_filters
from tablewarden.llm.common import Scratch, WordHashes, components
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark):
    return brute.corpus(spark)


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(50)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(frame, Scratch(spark)).collect()}
    assert found == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_jaccard_join(spark, docs):
    found = Counter(map(tuple, jaccard.near_duplicates(docs).collect()))
    assert found == brute.near_components(brute.rows(docs))


def test_jaccard_join_of_variants(spark):
    """Families without a common pivot, and a passage in many texts."""
    rng = np.random.default_rng(5)
    base, passage = [f"w{i}" for i in range(120)], [f"p{i}" for i in range(60)]
    texts = []
    for k in range(90):
        w = list(base)
        for at in range(k, min(k + 6, 120)):  # neighbours are alike, distant ones are not
            w[at] = f"x{k}_{at}"
        texts.append(" ".join(w[: 100 + k % 20]))
    for k in range(60):
        own = [f"o{v}" for v in rng.integers(0, 10**9, 50)]
        texts.append(" ".join(own[:25] + passage + own[25:]))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = Counter(map(tuple, jaccard.near_duplicates(frame).collect()))
    assert found == brute.near_components(list(enumerate(texts)))


def test_hashes_of_windows():
    """The polynomial of each window, in passes that grow with the logarithm of its size."""
    from tablewarden.llm import common

    class Counted(np.ndarray):
        sums = 0

        def __array_ufunc__(self, ufunc, method, *given, **options):
            Counted.sums += ufunc is np.add
            plain = lambda xs: tuple(x.view(np.ndarray) if isinstance(x, Counted) else x for x in xs)
            options |= {"out": plain(options["out"])} if "out" in options else {}
            return getattr(ufunc, method)(*plain(given), **options).view(Counted)

    words = np.random.default_rng(3).integers(0, 2**63, 70).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for size in (*range(1, 20), 64, 70):
        want = []
        for k in range(len(words) - size + 1):
            h = size
            for w in words[k : k + size].tolist():
                h = (h * 0x9E3779B97F4A7C15 + w) % 2**64
            want.append(h)
        assert common.windows(words, size).tolist() == common.mixed(np.array(want, np.uint64)).tolist()
    common.windows(words.view(Counted), 64)
    assert 0 < Counted.sums <= 14


@pytest.mark.parametrize("best", [1, 8])
def test_families_bring_few_candidates(spark, monkeypatch, best):
    """Variants that link with few others, though most pairs may: candidates grow with the
    members, and what is held back is searched again."""
    import pandas as pd

    rng, n = np.random.default_rng(7), 160
    texts = []
    for k in range(n):
        w = [f"w{i}" for i in range(200)]
        for at in rng.choice(200, 3, replace=False):
            w[at] = f"x{k}_{at}"
        texts.append(" ".join(w))
    sets = [jaccard.shingles(t, WordHashes()) for t in texts]
    group = pd.DataFrame(
        {
            "token": 7, "i": 0, "j": 0, "block": 0, "rep": range(n), "label": range(n), "n": [len(s) for s in sets],
            "bits": [jaccard.bitmap(s).tobytes() for s in sets],
        }
    )
    assert len(jaccard._candidates(group)) > n * n / 8
    some = jaccard._candidates(group, best)
    assert n / 2 <= len(some) <= 2 * best * n + 1 and ((some["a"] == 0) & (some["b"] == 0)).sum() == 1
    assert len(jaccard._candidates(group, n)) == len(jaccard._candidates(group))
    monkeypatch.setattr(jaccard, "BEST", best)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = Counter(map(tuple, jaccard.near_duplicates(frame).collect()))
    assert found == brute.near_components(list(enumerate(texts)))


def test_rare_shingles_are_shuffled_once(spark):
    """The counts of groups and the join with them share one shuffle."""
    rows = [(k, 40, [k % 7, k % 3 + 10, 100 + k], [k % 2 + 1000]) for k in range(60)]
    shapes = spark.createDataFrame(rows, "rep long, n long, common array<long>, frequent array<long>")
    members = jaccard._members(shapes)
    members.collect()
    plan = members._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line and "ReusedExchange" not in line]
    assert len(dealt) == 1, plan


@settings(max_examples=40, deadline=None)
@given(st.data())
def test_trees_lose_no_link(data):
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    sets = []
    for _ in range(60):
        n = int(rng.integers(3, 200))
        own = rng.integers(0, 2**63, n).astype(np.uint64)
        sets.append(np.unique(own))
        for _ in range(int(rng.integers(0, 3))):
            copy = own.copy()
            change = int(rng.integers(0, n // 4 + 1))
            copy[:change] = rng.integers(0, 2**63, change).astype(np.uint64)
            sets.append(np.unique(copy))
    import pandas as pd

    m = len(sets)
    group = pd.DataFrame(
        {
            "token": 7, "groups": [[7, 9]] * m, "i": 0, "j": 0, "block": 0, "rep": range(m), "label": range(m),
            "n": [len(s) for s in sets], "bits": [jaccard.bitmap(s).tobytes() for s in sets],
        }
    )
    found = set(map(tuple, jaccard._candidates(group).itertuples(index=False)))
    for a in range(m):
        for b in range(a + 1, m):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                assert (a, b) in found


@pytest.mark.parametrize("hot", [substring.HOT, 1, 4])
def test_suffix_array_dedup(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    found = substring.repeated_bytes(docs)
    got = Counter(
        (r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found.collect()
    )
    assert got == brute.removed(brute.rows(docs))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=90).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=2, max_size=400))
def test_deep_shallow_sorts(strings):
    order, prefixes = substring.deep_shallow(strings)
    assert [strings[i] for i in order] == sorted(strings)
    for k in range(1, len(strings)):
        a, b = strings[order[k - 1]], strings[order[k]]
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert prefixes[k] == n


def test_both_ways_through_a_gram_agree(monkeypatch):
    rng = np.random.default_rng(1)
    core = bytes(rng.integers(97, 101, 400, dtype=np.uint8))
    pairs = set()
    for _ in range(80):
        a, b = int(rng.integers(0, 170)), int(rng.integers(32, 201))
        noise = bytes(rng.integers(97, 101, 400, dtype=np.uint8))
        data = noise[: 200 - a] + core[200 - a : 200 + b] + noise[200 + b :]
        pairs.add((data[200 - 168 : 200][::-1], data[200:400]))
    lefts, rights = map(list, zip(*sorted(pairs), strict=True))
    small = substring.shared_strings(lefts, rights)
    monkeypatch.setattr(substring, "PAIRS", 2)
    large = substring.shared_strings(lefts, rights)
    assert small[0].any()
    assert (small[0] == large[0]).all() and (small[1] == large[1]).all()


def test_quality_counts(spark, docs):
    got = Counter(
        tuple(r) for r in quality.measured(docs.select("doc_id", "text"))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    )
    assert got == Counter((i, *brute.quality(t)) for i, t in brute.rows(docs))


def test_quality_verdicts(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    found = quality.assess(docs, labels)
    assert found.count() == docs.count()
    for r in found.collect():
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)  # three labels allow no cutoff
    assert quality.assess(docs.limit(0), labels).count() == 0


def test_binomial_bound():
    assert quality.binomial_cdf(0, 10, 0.5) == pytest.approx(1 / 1024)
    assert quality.binomial_cdf(3, 20, 0.1) == pytest.approx(0.8670466766)
    assert quality.binomial_cdf(20, 20, 0.3) == 1.0


def test_binomial_bound_of_many_terms():
    for n, p in ((50, 0.3), (400, 0.004), (3000, 0.02)):
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(n + 1)]
        terms = [math.exp(x + i * math.log(p) + (n - i) * math.log1p(-p)) for i, x in enumerate(logs)]
        for k in (0, 1, int(n * p), int(n * p) + 1, 2 * int(n * p) + 3, n - 1):
            assert quality.binomial_cdf(k, n, p) == pytest.approx(math.fsum(terms[: k + 1]), abs=1e-9)
    assert 0.4 < quality.binomial_cdf(4_000_000, 10**9, 0.004) < 0.6


def test_ordered_tests_keep_their_promise():
    """Over simulated holdouts, a cutoff over the limit is chosen no more often than the level."""
    rng, limit, level, n, runs = np.random.default_rng(3), 0.02, 0.05, 1500, 2000
    rates = np.linspace(0.06, 0.001, len(quality.CUTOFFS))  # of good rows beyond each cutoff
    wrong = chosen = 0
    for _ in range(runs):
        values = np.sort(rng.random(n))
        rejected = np.searchsorted(values, rates).tolist()  # nested, as cutoffs are
        at = quality.strictest(rejected, n, limit, level)
        chosen += at is not None
        wrong += at is not None and rates[at] > limit
    assert chosen == runs and wrong / runs <= level + 3 * math.sqrt(level / runs)
    assert quality.strictest([0] * len(rates), 100, limit, level) is None  # too few to tell


def test_kept_against_plain_verdicts(spark):
    """Enough labels select cutoffs in one stratum; each row's verdict follows from them."""
    rows, labels = [], []
    for i in range(2400):
        words = [f"w{i}x{k}" for k in range(20)]
        junk = i % 8 == 7
        rows.append((i, "en" if i < 2300 else "de", " ".join(words) + " " + "#" * (400 if junk else 0)))
        labels.append((i, int(not junk)))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    found = quality.assess(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    kept = {r.doc_id: r.kept for r in found}
    assert len(found) == len(rows) and not any(r.base_failed for r in found)
    assert kept == {i: lang == "de" or i % 8 != 7 for i, lang, _ in rows}


def test_cutoffs_respect_the_limit(spark):
    n = 20_000
    frame = spark.range(n).select(
        F.lit("en").alias("stratum"),
        *((F.col("id") / n * 0.9505 if m == "symbol_share" else F.lit(0.999)).alias(m) for m in quality.MEASURES),
    )
    chosen = quality.thresholds(frame, 0.05, 0.05)
    assert set(chosen) == {("en", "symbol_share")}  # the others would reject everything
    rejected = frame.filter(F.col("symbol_share") > chosen["en", "symbol_share"]).count()
    assert 0 < rejected <= 0.05 / len(quality.MEASURES) * n


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    limits = packing.Limits(2048, 64, 2048)
    plain = Tokenizer.from_file(packing.default_tokenizer())
    special = spark.createDataFrame([(5_000_000, "ends <|endoftext|> here", "en")], "doc_id long, text string, lang string")
    texts = docs.select("doc_id", "text", "lang").union(special)
    pieces = packing.pack(texts, packing.default_tokenizer(), limits).collect()
    expected = Counter()
    for i, t in brute.rows(texts):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        expected[i, len(ids)] += 1
    got = Counter()
    starts = Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0)
    assert starts == expected
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id, p.doc_tokens].append((p.start, p.length, p.ids_crc32))
    for i, t in brute.rows(texts):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        mine = sorted(by_doc[i, len(ids)])
        assert sum(length for _, length, _ in mine) == len(ids) * expected[i, len(ids)]
        if expected[i, len(ids)] == 1:
            assert [s for s, _, _ in mine] == list(np.cumsum([0] + [n for _, n, _ in mine])[:-1])
            assert all(crc32(ids[s : s + n].tobytes()) == c for s, n, c in mine)
        got[i] += 1
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    padding = tokens = 0
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
        size = sum(n for _, n in parts)
        assert size <= 2048 and len(parts) <= 64
        padding += 0 if size & (size - 1) == 0 else 2048 - size
        tokens += size
    assert padding <= 0.01 * tokens


def test_packing_limits_and_empty(spark):
    frame = spark.createDataFrame(
        [(i, "word " * (i % 40 + 1), i % 30) for i in range(400)], "doc_id long, text string, prompt int"
    ).coalesce(2)
    pieces = packing.pack(frame, packing.default_tokenizer(), packing.Limits(256, 6, 120), "prompt").collect()
    prompts = {i: i % 30 for i in range(400)}
    sequences = defaultdict(list)
    for p in pieces:
        loss = sum(1 for k in range(p.start, p.start + p.length) if k >= prompts[p.doc_id])
        sequences[p.sequence_id].append((p.length, loss))
    for parts in sequences.values():
        assert sum(n for n, _ in parts) <= 256 and len(parts) <= 6 and sum(x for _, x in parts) <= 120
    assert packing.pack(frame.limit(0), packing.default_tokenizer()).count() == 0


URLS = [
    ("http://EXAMPLE.com/en/a?x", "example.com", "/en/a", "example.com/en/", "block"),
    ("http://www.example.com/en/a#x", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("http://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://x.net/es/?q", "x.net", "/es/", "net/es/", "block"),
    ("http://x.net/de/", "x.net", "/de/", None, "allow"),
    ("http://com", "com", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("nothing", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u[0], None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    found = {r.page_id: r for r in url_filters.judge(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (found[i].host, found[i].path, found[i].rule, found[i].verdict) == (host, path, rule, verdict)


def test_links_as_a_browser_reads_them(spark):
    def canonical(url, more=""):
        return f'<link {more} href="{url}" rel="canonical">'

    bad = "http://x.example.com/en/bad"
    edges = {
        "http://a.org": ("HTTP://A.ORG/", None),  # one page, so no edge
        "http://b.org/x": ("http://B.org?p=1&amp;q=2#top", "b.org/?p=1&q=2"),
        "http://c.org/x/y/z": ("../.././w/./v/..", "c.org/w/"),
        "http://d.org/x/y?old": ("?new", "d.org/x/y?new"),
        "http://e.org/x": ("mailto:someone", None),
        "http://f.org/x": ("#part", None),
        "http://g.org/x": ("y?next=http://h.org/", "g.org/y?next=http://h.org/"),
    }
    pages = [(k, url, canonical(target)) for k, (url, (target, _)) in enumerate(edges.items())]
    pages += [
        (20, "http://i.org/", f"<!-- {canonical(bad)} > {'-' * 9000} -->"),
        (21, "http://j.org/", f"<!-- open {canonical(bad)}"),
        (22, "http://k.org", canonical(bad, f"title='{'t' * 50_000}'")),
        (23, "http://K.org/#x", None),
        (24, "http://l.org/", f'<link rel=canonical data-href="{bad}">'),
        (25, "http://m.org/", "<!--" * 20_000 + canonical(bad) + "<link " * 20_000),
        (26, None, canonical(bad)),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {tuple(r) for r in url_filters.alias_edges(frame).collect()}
    expected = {(u.split("//", 1)[1], node) for u, (_, node) in edges.items() if node}
    assert found == expected | {("k.org/", "x.example.com/en/bad")}
    verdicts = {r.page_id: r.verdict for r in url_filters.judge(frame).collect()}
    assert {k for k, v in verdicts.items() if v == "block"} == {22, 23}


def test_url_aliases(spark):
    def canonical(url):
        return f"<head><LINK href='{url}' rel=canonical></head>"

    pages = [
        (1, "http://one.org/a", canonical("https://x.example.com/en/bad")),  # alias of a blocked page
        (2, "http://two.org/b?p=1#top", '<meta http-equiv="refresh" content="0; url=http://one.org/a">'),
        (3, "http://www.example.com/en/ok", canonical("http://two.org/b?p=1")),  # explicit allow
        (4, "http://four.org/c/d", canonical("../e") + canonical("/c/f")),
        (5, "http://four.org/c/f", None),
        (6, "http://six.org/", "<a href=http://x.example.com/en/bad>"),  # a link is no alias
        (2, "http://two.org/b?p=1#top", None),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("component", F.lit("x"))
    found = url_filters.judge(frame).collect()
    assert len(found) == 7
    verdicts = {r.page_id: r.verdict for r in found}
    assert verdicts == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow"}
    component = {r.page_id: r.component for r in found}
    assert component[1] == component[2] == component[3] != component[4] == component[5]
    assert component[6] is None
    edges = spark.createDataFrame([("http://six.org/", "http://one.org/a")], "source string, target string")
    again = {r.page_id: r.verdict for r in url_filters.judge(frame, edges=edges).collect()}
    assert again[6] == "block"
    assert url_filters.judge(frame.limit(0)).count() == 0


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert jaccard.near_duplicates(none).count() == 0
    assert substring.repeated_bytes(none).count() == 0


def test_bitmaps_fold():
    tokens = np.array([1, 70, 200, 5000], np.uint64)
    wide = np.zeros(256 // 64, np.uint64)
    for t in tokens.tolist():
        wide[t % 256 // 64] |= np.uint64(1 << (t % 64))
    narrow = jaccard.fold(wide, 1)
    assert narrow[0] == jaccard.fold(jaccard.bitmap(tokens), 1)[0]
    assert len(jaccard.shingles("A b\u00a0c", WordHashes())) == 1
