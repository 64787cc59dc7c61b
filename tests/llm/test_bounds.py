"""Very long runs of blanks and binding limits in packing, and the bounded sample of the toxicity scorer."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablewarden.llm import jaccard, packing, toxicity
from tablewarden.llm.common import load
from tests.comparison import folder
from tests.llm import brute

RUNS = {1: "x" + " " * 2_000_000 + "y", 2: "\n" * 1_200_000, 3: "a b " + "\t" * 1_500_000, 4: "short"}


@pytest.fixture(scope="module")
def runs(spark):
    rows = [(i, text, "en", "s", len(text)) for i, text in RUNS.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def check_pieces(rows):
    """Every id of every text lies in one piece, as ``tokenizers`` encodes the text."""
    plain = packing.Encoder(packing.default_tokenizer()).plain
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(RUNS)
    for i, text in RUNS.items():
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, packing.END], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_packing_of_long_runs(runs):
    check_pieces(packing.pack(runs, packing.default_tokenizer()).collect())


def test_the_pipelines_packing_of_long_runs(spark, runs):
    check_pieces(corpus_pipeline.packed(spark, runs, folder("0.001")).collect())


def test_the_pipelines_packing_has_limits_that_bind(spark):
    """Surrogates bear no loss; tokens, segments and loss each close sequences, and pieces say which."""
    who = "Grüße жук: mail anna{0}@corp.com, card 4111 1111 1111 1111 or Dr. Smith; later Smith said ÄÖ so"
    here = r"mail (\S+), card ([\d ]+) or Dr\. (\w+); later (\w+) said"
    texts = [f"short text {i} of some words" for i in range(2000)]
    texts += [" ".join(f"word{i}x{k}" for k in range(3000)) for i in range(3)]
    texts += [" ".join(who.format(f"{i}a{k}") for k in range(n)) for i, n in enumerate([1] * 40 + [300])]
    docs = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id long, text string").withColumns(
        {"lang": F.lit("de"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}
    )
    docs = corpus_pipeline.pseudonymised(spark, docs, folder("0.001")).repartition(2, "doc_id").cache()
    tokenizer, bears = packing.Encoder(packing.default_tokenizer()).plain, {}
    for i, text in brute.rows(docs):
        spans = [m.span(k) for m in re.finditer(here, text or "") for k in range(1, 5)]
        assert len(spans) == 4 * (texts + ["", ""])[i].count("mail")
        ends = tokenizer.encode(text or "", add_special_tokens=False).offsets
        a, b = np.array([*ends, (0, 0)], int).T
        bears[i] = np.ones(len(ends) + 1, int)
        for start, end in spans:
            bears[i][:-1][(a[:-1] < end) & (b[:-1] > start)] = 0
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.packed(spark, docs, folder("0.001")).collect():
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append(r)
        assert r.loss == bears[r.doc_id][r.start : r.start + r.length].sum() and r.doc_tokens == len(bears[r.doc_id])
    for i, bear in bears.items():
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at
            at += length
        assert at == len(bear)
    limits, closed = corpus_pipeline.LIMITS, Counter()
    for rows in sequences.values():
        (reason,) = {r.closed_by for r in rows}
        used = {"tokens": sum(r.length for r in rows), "segments": len(rows), "loss": sum(r.loss for r in rows)}
        assert all(n <= getattr(limits, k) for k, n in used.items())
        size = used["tokens"]
        assert size & (size - 1) == 0 if reason == "end" else used[reason] == getattr(limits, reason)
        closed[reason] += 1
    assert closed.keys() == {"tokens", "segments", "loss", "end"}


def test_the_last_tokens_need_no_padding_under_few_segments():
    packer = packing.Packer(packing.Limits(2048, 4, 100), 0)
    for i in range(40):
        packer.add(i, np.arange(30 + i % 3, dtype="<u4"), np.ones(30 + i % 3, np.int8))
    packer.finish()
    sizes, segments = Counter(), Counter()
    for row in packer.taken():
        sizes[row[5]] += row[2]
        segments[row[5]] += 1
    assert sum(sizes.values()) == sum(30 + i % 3 for i in range(40))
    assert all(n & (n - 1) == 0 for n in sizes.values()) and max(segments.values()) <= 4


def test_the_sample_of_labels_is_bounded_and_enough(spark):
    docs, labels = (load(spark, folder("0.1"), t) for t in ("documents", "labels"))
    train = labels.filter(~toxicity.held_out(F.col("doc_id")))
    scorer = toxicity.train(docs, train, 2000)
    held = docs.join(labels.filter(toxicity.held_out(F.col("doc_id"))).select("doc_id", "toxic"), "doc_id")
    found = toxicity.score(held.select("doc_id", "text", "toxic"), scorer).select("predicted", "toxic").collect()
    assert np.mean([r.predicted == r.toxic for r in found]) > 0.97


def test_a_sample_of_no_less_than_the_labels_is_all_of_them(spark):
    docs, labels = (load(spark, folder("0.01"), t) for t in ("documents", "labels"))
    n = labels.count()
    one, two = (toxicity.train(docs, labels, k) for k in (n, 100 * n))
    assert one.weights == two.weights and one.weights


def test_documents_that_share_passages(spark):
    """Each holds two of forty passages, so shingles have many documents, and none links to another
    but the variants; those share just enough."""
    rng = np.random.default_rng(11)
    passages = [[f"p{k}_{i}" for i in range(60)] for k in range(40)]
    texts = []
    for k in range(300):
        own = [f"o{v}" for v in rng.integers(0, 10**9, 400)]
        a, b = rng.integers(0, 40, 2)
        texts.append(own[:150] + passages[a] + own[150:300] + passages[b] + own[300:])
    for k in range(0, 60, 2):  # around the threshold: 520 words, some of them changed in one stretch
        w = list(texts[k])
        change = 30 + 2 * k
        w[200 : 200 + change] = [f"c{v}" for v in rng.integers(0, 10**9, change)]
        texts.append(w)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = Counter(map(tuple, jaccard.near_duplicates(frame).collect()))
    assert found == brute.near_components(rows)
    sizes = Counter(c for _, _, c in found)
    assert 5 < sum(n > 1 for n in sizes.values()) < 30  # some variants link, others do not
