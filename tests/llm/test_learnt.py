"""Operators without one right answer: properties, planted cases, held-out accuracy."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablewarden.llm import chunk_dedup, decontamination, licences, pii, toxicity
from tablewarden.llm.common import load
from tests.comparison import folder
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark):
    return brute.corpus(spark)


# --- toxicity ------------------------------------------------------------------------


def test_restores_hidden_words(spark):
    docs = load(spark, folder("0.01"), "documents")
    model = toxicity.character_model(docs)
    restorer = toxicity.Restorer(model)
    for hidden, plain in [
        ("1d10t", "idiot"), ("id1ot", "idiot"), ("m0r0n", "moron"), ("w0rthl3ss", "worthless"), ("$tup1d", "stupid"),
        ("idiooot", "idiot"), ("i.d.i.o.t", "idiot"), ("s-t-u-p-i-d", "stupid"), ("trashhhh", "trash"),
        ("d1sgust1ng!!!", "disgusting"), ("idiot###", "idiot"), ("“moron,”", "moron"),
    ]:
        assert plain in restorer.words(f"was the {hidden} of"), hidden
    assert "idiot" in restorer.words("the i d i o t and")
    assert restorer.words("Plain words, only; words.") == {"plain", "words", "only"}
    assert restorer.words(None) == restorer.words("") == restorer.words(" \n") == set()


def test_no_gate_before_the_lattice(spark):
    restorer = toxicity.Restorer(toxicity.character_model(load(spark, folder("0.01"), "documents")))
    for hidden, plain in [
        ("idi" + "o" * 80 + "t", "idiot"), ("idi" + "o" * 5000 + "t", "idiot"), ("1d10t" + "." * 70 + "x", "idiot"),
        (".".join(["you", "are", "an", "utter", "idiot"] * 9), "idiot"), ("you-are-a-w0rthl3ss-" * 9 + "one", "worthless"),
        ("!diot", "idiot"), ('"!diot!"', "idiot"), ("(!diot)", "idiot"), ("(!diot!!!", "idiot"),
        ("idioot", "idiot"), ("idioot-face", "idiot"), ("mor-ons", "morons"),
    ]:
        assert plain in restorer.words(f"was the {hidden} of"), hidden[:80]
    for hidden in ("@$$", "455", "10", "(455)"):  # letters only by their look-alikes
        assert all(w.isalpha() for w in restorer.words(hidden)) and restorer.words(hidden), hidden
    assert restorer.words("!!! -- ... ,") == set()
    # a word with a doubled letter stays as it is, too
    assert {"letter", "stop"} <= restorer.words("a letter, stop!")
    spaced = " ".join("x" * 300) + " i d i o t"
    assert "idiot" in "".join(restorer.words(spaced))


def test_held_out_accuracy(spark):
    found = toxicity_of(spark, "0.1").filter("held_out").join(load(spark, folder("0.1"), "labels"), "doc_id")
    pairs = [(r.score, r.toxic) for r in found.collect()]
    good, bad = [s for s, t in pairs if not t], [s for s, t in pairs if t]
    auc = np.mean([(b > np.array(good)).mean() + 0.5 * (b == np.array(good)).mean() for b in bad])
    caught, wrong = np.mean([s >= 0.7 for s in bad]), np.mean([s >= 0.7 for s in good])
    print("auc", auc, "caught", caught, "wrongly", wrong)
    assert auc > 0.9 and caught > 0.7 and wrong < 0.02


def toxicity_of(spark, sf):
    return toxicity.op2_toxicity(spark, folder(sf))


def test_toxicity_edges(spark, docs):
    labels = load(spark, folder("0.001"), "labels")
    scorer = toxicity.train(docs, labels)
    found = toxicity.score(docs, scorer)
    assert found.count() == docs.count()
    assert found.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert set(found.columns) == {*docs.columns, "score", "predicted"}
    assert toxicity.score(docs.limit(0), scorer).count() == 0
    nothing = toxicity.train(docs.limit(0), labels.limit(0))
    assert toxicity.score(docs, nothing).filter("predicted = 1").count() == 0


# --- substring dedup -----------------------------------------------------------------


def test_gear_rolls():
    data = bytes(random.Random(1).randrange(256) for _ in range(500))
    h, expected = 0, []
    for b in data:
        h = ((h << 1) + int(chunk_dedup.GEAR[b])) % 2**32
        expected.append(h)
    assert chunk_dedup.gear(data).tolist() == expected
    assert chunk_dedup.cuts(b"") == []
    for n in (1, 23, 24, 200, 5000):
        ends = chunk_dedup.cuts(bytes(n))
        assert ends[-1] == n and max(np.diff([0, *ends])) <= chunk_dedup.MOST


def test_cuts_in_steps(monkeypatch):
    data = bytes(random.Random(2).randrange(97, 123) for _ in range(9000))
    whole = chunk_dedup.cuts(data)
    monkeypatch.setattr(chunk_dedup, "STEP", 1000)
    assert chunk_dedup.cuts(data) == whole


def plain_chunk_spans(docs):
    """The first chunk by (doc_id, start), with its surroundings, stays; one row per doc_id here."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data, last, gone = text.encode(), 0, bytearray(len(text.encode()))
        for end in chunk_dedup.cuts(data):
            around = slice(max(0, last - 32), end + 32)
            key = (data[around], last - around.start, end - last)
            if key in seen:
                gone[around] = b"\x01" * len(data[around])
            seen.add(key)
            last = end
        runs = [m.span() for m in re.finditer(rb"\x01+", bytes(gone))]
        runs = [r for r in runs if r[1] - r[0] >= 89 or r == (0, len(data))]
        if runs:
            out[doc_id] = runs
    return out


def test_chunk_dedup(spark):
    frame = load(spark, folder("0.001"), "documents").select("doc_id", "text")
    found = Counter((r.doc_id, r.start, r.stop) for r in chunk_dedup.repeated_spans(frame).collect())
    expected = plain_chunk_spans([(i, t or "") for i, t in brute.rows(frame)])
    assert found == Counter((i, a, b) for i, runs in expected.items() for a, b in runs)


def test_chunks_resist_shifts(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(60))
    texts = [" ".join(word() for _ in range(rng.randint(10, 90))) + " " + passage + " " + word() for _ in range(40)]
    texts += [" ".join(word() for _ in range(80)) for _ in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in chunk_dedup.repeated_spans(frame).collect()}
    assert len(found) >= 38 and 0 not in found and not set(found) & set(range(40, 60))
    assert all(r.first_doc_ids for r in found.values())


def test_every_passage_of_51_words_is_found(spark):
    texts = [t for _, t in brute.rows(load(spark, folder("0.01"), "documents")) if t]
    vocabulary, rng = [w for t in texts for w in t.split()], random.Random(6)
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows = []
    for k in range(600):
        passage = some(51)
        for half in range(2):
            text = [*some(rng.randint(10, 90)), *passage, *some(rng.randint(1, 40))]
            rows.append((2 * k + half, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, i) for r in chunk_dedup.repeated_spans(frame).collect() for i in r.first_doc_ids}
    assert {(2 * k + 1, 2 * k) for k in range(600)} <= found


def test_phrases_in_common_stay(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    phrase = " ".join(word() for _ in range(60))[:75]
    some = lambda n: " ".join(word() for _ in range(n))
    texts = [f"{phrase} {some(60)} {phrase} {some(60)} {phrase}" for _ in range(200)]
    texts += ["a whole text that is short"] * 2
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [(r.doc_id, r.start, r.stop) for r in chunk_dedup.repeated_spans(frame).collect()]
    assert found == [(201, 0, 26)]


def test_spans_equal_earlier_bytes(spark):
    """Nothing that is found once goes: every span lies whole in what stands before it."""
    frame = load(spark, folder("0.001"), "documents").select("doc_id", "text")
    data = {i: (t or "").encode() for i, t in brute.rows(frame)}
    at = {i: b"\0".join(d for j, d in sorted(data.items()) if j < i) for i in data}
    found = chunk_dedup.repeated_spans(frame).collect()
    assert found
    for r in found:
        span = data[r.doc_id][r.start : r.stop]
        earlier = at[r.doc_id] + b"\0" + data[r.doc_id][: r.stop - 1]
        covered, last = 0, 0
        for a, b, _ in chunk_dedup.keyed(span):
            covered += span[max(0, a - 32) : b] in earlier
            last += 1
        assert covered >= last - 2, (r.doc_id, r.start)  # at seams of two sources a chunk may straddle


def test_texts_without_ids_are_told_apart(spark):
    rng = random.Random(9)
    some = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage, rows = some(60), []
    for k in range(6):
        rows.append((None if k < 3 else 7, f"{some(20 + k)} {passage} {some(30)}"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = chunk_dedup.repeated_spans(frame).collect()
    assert len(found) == 5 == len({(r.doc_id, r.part) for r in found})


def test_chunk_dedup_edges(spark, docs):
    found = [tuple(r[:4]) for r in chunk_dedup.repeated_spans(docs).collect()]
    assert {900007} <= {r[0] for r in found}
    # a short text that repeats whole goes; a stretch of 800 equal pairs goes but for its start
    assert {900005, 900010} <= {r[0] for r in found}
    assert not {None, 900001, 900002, 900003, 900004, 900011} & {r[0] for r in found}
    assert chunk_dedup.repeated_spans(docs.limit(0)).count() == 0


# --- licences ------------------------------------------------------------------------


def test_licences(spark):
    mit = licences.TEMPLATES["MIT-header"]
    rows = [
        (1, "some words here\nReleased under the MIT License.\nmore words"),
        (2, "released UNDER the  mit license"),
        (3, mit.replace("free of charge", "without charge")),
        (4, "before it " * 60 + "\n\n" + mit[:120] + "\n" + mit[120:] + "\n\nafter it"),
        (5, "nothing of that kind, a license to nothing"),
        (6, None), (7, ""), (8, "\n\n\n"), (9, "x " * 200_000),
        (1, "some words here\nReleased under the MIT License.\nmore words"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    found = licences.licence_matches(frame).collect()
    assert Counter((r.doc_id, r.licence) for r in found) == Counter(
        {(1, "MIT"): 2, (2, "MIT"): 1, (3, "MIT-header"): 1, (4, "MIT-header"): 1}
    )
    text = rows[3][1]
    match = next(r for r in found if r.doc_id == 4)
    assert text[match.start : match.stop] == text.split("\n\n")[1]
    assert licences.licence_matches(frame.limit(0)).count() == 0


def test_size_bounds_lose_no_match(spark):
    scanner = licences.Scanner(licences.TEMPLATES, licences.LEAST)
    rng = random.Random(8)
    for name, template in licences.TEMPLATES.items():
        for _ in range(40):
            words = template.split()
            for _ in range(rng.randint(0, 3)):
                words.insert(rng.randrange(len(words) + 1), "zzz")
            for _ in range(rng.randint(0, 2)):
                del words[rng.randrange(len(words))]
            unit = " ".join(words)
            own = licences.bigrams(unit)
            scores = sorted(
                (-licences.dice(own, licences.bigrams(t)), n) for n, t in licences.TEMPLATES.items()
            )
            expected = (scores[0][1], -scores[0][0]) if -scores[0][0] >= licences.LEAST else None
            assert scanner.best(unit) == expected, name


# --- decontamination -----------------------------------------------------------------


def plain_contaminations(docs, items):
    """Pairs whose item lies word for word in the document."""
    out = set()
    for doc_id, text in docs:
        joined = " " + " ".join((text or "").split()) + " "
        out |= {(doc_id, i) for i, t in items if f" {' '.join(t.split())} " in joined}
    return out


def test_finds_benchmark_passages(spark):
    docs, items = load(spark, folder("0.01"), "documents"), load(spark, folder("0.01"), "benchmark")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminations(docs, items).collect()}
    expected = plain_contaminations(brute.rows(docs), [tuple(r) for r in items.select("item_id", "text").collect()])
    assert expected and expected <= found
    # what comes on top shares a long run of words with its item
    texts, of = dict(brute.rows(docs)), {r.item_id: r.text for r in items.collect()}
    for doc_id, item in found - expected:
        a, b = (x.lower().split() for x in (texts[doc_id], of[item]))
        runs = {tuple(a[i : i + 8]) for i in range(len(a) - 7)}
        assert sum(tuple(b[i : i + 8]) in runs for i in range(len(b) - 7)) >= 1


def test_catches_other_parameters(spark):
    items = [
        (1, "If Alice buys 12 apples for 3 kg and gives 5 of them to Bob, how many apples does Alice have left in total?"),
        (2, "only five words right here"),
        (3, "too short"),
        (4, None),
    ]
    docs = [
        (1, "Well. If Carla buys 47 apples for 8 lb and gives 9 of them to Dan, how many apples does Carla have left in total? Yes."),
        (2, "Well. If Carla buys 47 apples for 8 lb and gives 9 of them to Dan, how many apples does Erik have left in total? Yes."),
        (3, "if someone buys apples for a friend and gives most of them away how many are left in total then"),
        (4, "they wrote only five words right here and there"),
        (5, "too short"),
        (6, None), (7, ""),
        (1, "Well. If Carla buys 47 apples for 8 lb and gives 9 of them to Dan, how many apples does Carla have left in total? Yes."),
    ]
    a = spark.createDataFrame(docs, "doc_id long, text string").withColumn("h", F.lit("x"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("size", F.lit("x"))
    found = {(r.doc_id, r.item_id): r.exact for r in decontamination.contaminations(a, b).collect()}
    # in document 2 the name of the item became two names
    assert found == {(1, 1): False, (4, 2): True}
    assert decontamination.contaminations(a.limit(0), b).count() == 0
    assert decontamination.contaminations(a, b.limit(0)).count() == 0


def test_texts_that_share_an_id_are_judged_apart(spark):
    """Four texts with ten words each of an item's forty are clean, whatever their ids."""
    words = [f"{a}{b}" for a in ("lorem", "ipsum", "dolor", "amet", "elit") for b in "abcdefgh"]
    parts = [" ".join(words[k : k + 10]) for k in range(0, 40, 10)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    for ids in ([1, 2, 3, 4], [7] * 4, [None] * 4):
        frame = spark.createDataFrame(list(zip(ids, parts, strict=True)), "doc_id long, text string")
        assert decontamination.contaminations(frame, items).count() == 0
        whole = frame.union(spark.createDataFrame([(ids[-1], " ".join(words))] * 2, frame.schema))
        found = decontamination.contaminations(whole, items).collect()
        assert [(r.doc_id, r.item_id, r.exact) for r in found] == [(ids[-1], 1, True)]


def test_catches_short_items_in_any_context(spark):
    items = [
        (1, "The old baker sold many warm loaves before noon today"),
        (2, "Anna buys 4 pens and some paper at the store near home."),
        (3, "Then a train from Paris took 7 hours to reach the coast in heavy rain."),
        (4, "Rome Paris Oslo Bern 12 15"),
    ]
    docs = [
        (1, "Question 3\nThe old baker sold many warm loaves before noon today"),
        (2, "We say: Carla buys 19 pens and some paper at the store near home. Yes"),
        (3, "then a train from New York took twenty five hours to reach the coast in heavy rain."),
        (4, "so Rome Paris Oslo Bern 12 15 it was"),
        (5, "so Rome Paris Oslo Bern 13 15 it was"),
        (6, "the old baker went home and many warm days came before noon"),
        (7, "Task\nDora buys 3 pens and some paper at the store near home."),
    ]
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.exact for r in decontamination.contaminations(a, b).collect()}
    assert found == {(1, 1): True, (2, 2): False, (3, 3): False, (4, 4): True, (7, 2): False}


# --- PII -----------------------------------------------------------------------------

TEXTS = [
    "write to jo.81@mail7.example.com or JO.81@MAIL7.EXAMPLE.COM, call +1 (017) 555-7713.",
    "host 226.203.165.104 and 226.203.165.104; card 4539 1488 0343 6467, ssn 123-45-6789",
    'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" and DE89370400440532013000 end',
    "Mr. John Smith met Mrs. Mary Jones; Mr. Smith left. г-н Петров and г-жа Иванова came.",
    "call +1 017 555 7713 or jo.81@mail7.example.com",
    "no entity, version 2.0, year 1999, 10.5 and a@b",
]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def test_surrogates(spark):
    import re

    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None, ""])], "doc_id long, text string")
    frame = frame.withColumn("n_entities", F.lit("x"))
    out = {r.doc_id: r for r in pii.pseudonymise(frame, "k1").collect()}
    assert [out[i].n_entities for i in range(8)] == [3, 4, 2, 7, 2, 0, 0, 0]
    assert out[5].text == TEXTS[5] and out[6].text is None and out[7].text == ""
    first = re.fullmatch(r"write to (\S+) or (\S+), call (\+1 \(\d{3}\) \d{3}-\d{4})\.", out[0].text)
    mail, shouted, phone = first.groups()
    assert re.fullmatch(r"[a-z]{2}\.\d\d@m[0-9a-f]{8}\.example\.(com|net|org)", mail) and shouted == mail.upper()
    assert mail != "jo.81@mail7.example.com" and phone != "+1 (017) 555-7713"
    # the same number in another layout, the same mail in another text
    again = re.fullmatch(r"call (\+1 \d{3} \d{3} \d{4}) or (\S+)", out[4].text)
    assert again[2] == mail and re.sub(r"\D", "", again[1]) == re.sub(r"\D", "", phone)
    host, twice, card, ssn = re.fullmatch(
        r"host ([\d.]+) and ([\d.]+); card (\d{4} \d{4} \d{4} \d{4}), ssn (\d{3}-\d{2}-\d{4})", out[1].text
    ).groups()
    assert host == twice != "226.203.165.104" and all(0 < int(x) < 256 for x in host.split("."))
    assert luhn("4539 1488 0343 6467") and luhn(card) and card != "4539 1488 0343 6467" and ssn != "123-45-6789"
    assert re.fullmatch(r'token = "[0-9a-f]{40}" and DE\d{20} end', out[2].text) and "9233a8" not in out[2].text
    m = re.fullmatch(
        r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+); Mr\. (\w+) left\. г-н (\w+) and г-жа (\w+) came\.", out[3].text
    )
    assert m[1] in pii.MALE and m[3] in pii.FEMALE and m[2] == m[5] not in ("Smith", m[4])
    assert re.fullmatch("[А-Я][а-я]+в", m[6]) and re.fullmatch("[А-Я][а-я]+ва", m[7])
    other = {r.doc_id: r.text for r in pii.pseudonymise(frame, "k2").collect()}
    assert other[0] != out[0].text


@pytest.mark.parametrize("inline", [10_000, 0])
def test_collisions_are_resolved(spark, monkeypatch, inline):
    """5,000 names share some 48,000 short surrogates, so many first draws collide."""
    monkeypatch.setattr(pii, "INLINE", inline)
    names = [f"{a}{b}{c}" for a in "BCDFGHKLMN" for b in ("ab", "ec", "id", "of", "ug") for c in "abcdefgh"]
    frame = spark.createDataFrame([(i, f"saw Mr. {n} and Mr. {n}.") for i, n in enumerate(names)], "doc_id long, text string")
    out = [r.text for r in pii.pseudonymise(frame).collect()]
    found = [t.removeprefix("saw Mr. ").removesuffix(".").split(" and Mr. ") for t in out]
    assert all(a == b for a, b in found)
    assert len({a for a, _ in found}) == len(names)
    assert not {a for a, _ in found} & set(names)


def test_given_names_differ(spark):
    """Each given name has a surrogate of its own in its list, never itself; no surname gets one of these."""
    import re

    for key in ("k1", "k2"):
        swapped = pii.permuted(key)
        assert sorted(swapped) == sorted(swapped.values()) == sorted(pii.GIVEN) and all(a != b for a, b in swapped.items())
        assert all((a in pii.MALE) == (b in pii.MALE) and (a < "Ѐ") == (b < "Ѐ") for a, b in swapped.items())
    assert pii.permuted("k1") != pii.permuted("k2")
    # short names, whose surrogates of two syllables and an n are often Karen
    short = [f"{a}{b}{c}" for a in "BCDFGHKLMN" for b in "aeiou" for c in "bcdfghjklm"]
    short = [n for n in short if n not in pii.GIVEN]
    names = [*pii.GIVEN, *short]
    frame = spark.createDataFrame([(i, f"Mr. {n}") for i, n in enumerate(names)], "doc_id long, text string")
    made = {names[r.doc_id]: re.fullmatch(r"Mr\. (\w+)", r.text)[1] for r in pii.pseudonymise(frame, "k1").collect()}
    assert len(set(made.values())) == len(names) and all(a != b for a, b in made.items())
    assert {made[n] for n in pii.GIVEN} == set(pii.GIVEN) and not {made[n] for n in short} & set(names)


@pytest.mark.parametrize("inline", [10_000, 0])
def test_later_mentions_of_names(spark, monkeypatch, inline):
    import re

    monkeypatch.setattr(pii, "INLINE", inline)
    long = "Ab" + "c" * 60
    texts = [
        "Smith rang. Mr. Smith came. Later Smith left, and 'Smith' and SMITH's car. Contact Dr. Thomas or Thomas.",
        "Smith and Thomas are in no title here; Mr. Brown is, Brown-Jones, O'Brown, Browning and x_Brown are others.",
        "Herr Dr. Keller sagt: Dr. heisst nicht Keller. Mr. O'Neil's dog; O’Neil is spelled otherwise, O'Neil not.",
        f"Mr. {long} and {long}, mail Keller@example.com",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in pii.pseudonymise(frame, "k1").collect()}
    name = r"([A-Z][a-z]+)"
    m = re.fullmatch(
        rf"{name} rang\. Mr\. {name} came\. Later {name} left, and '{name}' and ([A-Z]+)'s car\. Contact Dr\. {name} or {name}\.",
        out[0].text,
    )
    assert len({x.lower() for x in m.groups()[:5]}) == 1 and m[1] != "Smith" and m[5] == m[1].upper()
    assert m[6] == m[7] != "Thomas" and m[6] in pii.MALE and out[0].n_entities == 7
    m = re.fullmatch(r"(.* Mr\. )(\w+)( is, .*)", out[1].text)
    assert m[2] != "Brown" and f"{m[1]}Brown{m[3]}" == texts[1] and out[1].n_entities == 1
    m = re.fullmatch(
        rf"Herr Dr\. {name} sagt: Dr\. heisst nicht {name}\. Mr\. (\w+)'s dog; O’Neil is spelled otherwise, (\w+) not\.", out[2].text
    )
    assert m[1] == m[2] != "Keller" and m[3] == m[4] and out[2].n_entities == 4
    assert "c" * 20 not in out[3].text and "Keller" not in out[3].text and out[3].n_entities == 3


def test_pii_of_documents(spark, docs):
    import re

    out = pii.pseudonymise(docs)
    assert out.columns == [*docs.columns, "n_entities"] and out.count() == docs.count()
    before, after = Counter(dict(brute.rows(docs)).values()), [t for _, t in brute.rows(out)]
    found = {m for t in before if t for m in re.findall(r"[\w.]+@[\w.]*example\.com|\+1 \(\d{3}\) \d{3}-\d{4}", t)}
    assert found and not any(m in t for t in after if t for m in found)
    assert pii.pseudonymise(docs.limit(0)).count() == 0


# --- the pipeline --------------------------------------------------------------------


def test_pipeline_stages(spark):
    sf = folder("0.01")
    given = load(spark, sf, "documents")
    docs = given
    labels = {r.doc_id: r.toxic for r in load(spark, sf, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = stage(spark, docs, sf)
        assert after.schema.names == given.columns and after.dtypes == given.dtypes
        after = spark.createDataFrame(after.collect(), given.schema)
        kept = {r.doc_id: r.text for r in after.collect()}
        gone = before.keys() - kept.keys()
        if name == "toxicity":
            assert gone and np.mean([labels.get(i, 1) for i in gone]) > 0.8
        if name == "ngram_jaccard_join":
            groups = {i: c for i, _, c in brute.near_components(list(before.items()))}
            assert kept.keys() == {i for i, c in groups.items() if i == c}
        if name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in load(spark, sf, "benchmark").collect()]
            assert {i for i, _ in plain_contaminations(list(before.items()), items)} <= gone
            assert len(gone) < 0.05 * len(before)
        if name == "pii":
            assert not gone and any(before[i] != kept[i] for i in kept)
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_keeps_names_apart(spark):
    """Its stage for personal data tells given names apart and finds their later mentions."""
    names = pii.MALE + pii.FEMALE
    frame = spark.createDataFrame([(i, f"Dr. {n} met {n}") for i, n in enumerate(names)], "doc_id long, text string")
    docs = frame.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(0).cast("long")})
    out = corpus_pipeline.pseudonymised(spark, docs, folder("0.001"))
    made = {r.doc_id: r.text.removeprefix("Dr. ").split(" met ") for r in out.collect()}
    assert out.columns == docs.columns and len({a for a, _ in made.values()}) == len(names)
    assert all(a == b != names[i] for i, (a, b) in made.items())
    assert out.filter("n_chars <> length(text)").isEmpty()


def test_pipeline_edges(spark):
    """Nulls, empty texts, repeated rows and an empty table pass through every stage."""
    base = brute.corpus(spark).select("doc_id", "text", "lang")
    docs = base.withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, folder("0.001")).count() >= 0


def test_pipeline_judges_rows_by_their_own_text(spark):
    question = load(spark, folder("0.001"), "benchmark").filter("length(text) > 120").orderBy("item_id").first().text
    some = lambda name: " ".join(f"{name}{i}" for i in range(30))
    rows = [
        (None, question), (None, some("b")), (None, some("c")), (None, some("c")), (None, some("a")),
        (1, some("a")), (2, some("a")), (2, some("own")), (3, some("r")), (3, some("r")),
        (4, question), (4, some("d")), (5, None), (6, ""), (6, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}
    )
    docs = docs.repartition(4).cache()
    clean = corpus_pipeline.decontaminated(spark, docs, folder("0.001"))
    assert Counter(brute.rows(clean)) == Counter(r for r in rows if r[1] != question)
    single = corpus_pipeline.one_of_each(spark, docs, folder("0.001"))
    assert single.columns == clean.columns == docs.columns
    assert Counter(brute.rows(single)) == Counter(
        [
            (4, question), (None, some("b")), (None, some("c")), (1, some("a")), (2, some("own")), (3, some("r")),
            (4, some("d")), (5, None), (6, ""), (6, ""),
        ]
    )
