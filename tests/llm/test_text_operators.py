"""Licences, decontamination, substrings and near-duplicates against brute force."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, licenses, neardup, substrings

from .data import TEXTS, edge_documents, empty_documents, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def folded(text):
    return WORD.findall((text or "").translate(FOLD))


def test_license_base_places(spark):
    texts = ["under the GNU General\nPublic License, gnu general public license", "MIT-License and Apache  License; CC BY-NC", "cc", None, "", "mité license", "apache license apache license"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(df).collect()}
    for i, t in enumerate(texts):
        w = folded(t)
        places = [(k, label) for phrase, label in licenses.BASE_PHRASES for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert r["n_words"] == len(w) and r["n_base"] == len(places)
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["base_labels"] == sorted({x for _, x in places})
        assert set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1


def test_license_diagonals_survive_edits(spark):
    notice = licenses.TEMPLATES[0][1].split()
    edited = notice[:20] + ["really"] + notice[20:40] + notice[41:]
    texts = ["intro words here " + " ".join(edited) + " the end", " ".join(notice[:12]), " ".join(reversed(notice))]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0]["labels"] == ["mit"] and got[0]["score"] > 0.6
    assert got[0]["spans"][0]["first"] == 3
    assert got[1]["labels"] == [] and got[1]["score"] < 0.6
    assert got[2]["labels"] == [] and got[2]["score"] == 0


def test_license_places_count_once(spark):
    """A few words of a notice over and over do not make it up; a template of many words needs its places beyond the first ones, too."""
    words = [f"t{i}" for i in range(150)]
    texts = [" ".join(words[:8] * 40), " ".join(words), " ".join(words[:60]), " ".join(words[60:]), " ".join(words[:30] + words[8:20] + words[30:])]
    df = spark.createDataFrame(list(enumerate(texts)) * 2, "doc_id long, text string")
    found = licenses.scan_licenses(df, [("long", " ".join(words)), ("mit", "t0 t1 t2 t3 t4")])
    got = sorted((r["doc_id"], round(max((s["share"] for s in r["spans"] if s["label"] == "long"), default=0.0), 6)) for r in found.collect())
    assert got == [x for x in [(0, 0.0), (1, 1.0), (2, 0.0), (3, 0.0), (4, round(117 / 147, 6))] for _ in range(2)]


def test_license_edges(spark):
    out = licenses.scan_licenses(edge_documents(spark))
    assert rows_of(out, "doc_id", "n_words") == sorted([(i, len(folded(t))) for i, t, _, _ in TEXTS], key=repr)
    assert licenses.scan_licenses(empty_documents(spark)).count() == 0


def brute_decontamination(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = folded(text)
        for s in range(max(len(w) - width + 1, 1) if w else 0):
            windows[tuple(w[s : s + width])].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = folded(text), set(), set()
        for n in {len(g) for g in windows}:
            for s in range(len(w) - n + 1):
                if own := windows.get(tuple(w[s : s + n])):
                    hit.update(range(s, s + n))
                    found |= own
        out.append((doc_id, len(w), len(hit), ",".join(sorted(map(str, found)))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_decontamination(spark, monkeypatch, broadcast):
    import random

    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_ROWS", broadcast)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 9, 10, 11, 30])))) for i in range(25)] + [(90, None), (91, "W1, w2.W3")]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 5, 60, 200])) + (folded(items[rng.randrange(25)][1]) if i % 2 else []))) for i in range(40)] + [(None, "w1 w2 w3"), (41, None)]
    got = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in got.collect()), key=repr)
    assert got == brute_decontamination(docs, items)


def test_decontamination_proximity(spark):
    docs = spark.createDataFrame([(1, "z b a d c e f g h i j k y"), (2, "a b c d"), (3, "a b c d e f g h i j")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a b c d e f g h i j")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, bench).collect()}
    assert (got[1]["n_items"], got[1]["n_near_items"]) == (0, 1)
    assert (got[2]["n_items"], got[2]["n_near_items"]) == (0, 0)
    assert (got[3]["n_items"], got[3]["n_near_items"], got[3]["contaminated"]) == (1, 1, True)


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(1, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "x"), (None, "one", "x")], "item_id long, text string, doc_id string")
    got = decontaminate.decontaminate(edge_documents(spark), bench)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in got.collect()), key=repr)
    assert got == brute_decontamination([(i, t) for i, t, _, _ in TEXTS], [(1, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu")])
    assert decontaminate.decontaminate(empty_documents(spark), bench).count() == 0
    none = decontaminate.decontaminate(edge_documents(spark), bench.limit(0))
    assert none.where("contaminated or n_hit > 0").count() == 0 and none.count() == len(TEXTS)


def brute_substrings(docs, width):
    seen = {}
    for i, t in docs:
        w = SPACED.findall(t or "")
        for s in range(len(w) - width + 1):
            g = tuple(w[s : s + width])
            if i is not None:
                seen[g] = min(seen.get(g, i), i)
    out = []
    for i, t in docs:
        w = SPACED.findall(t or "")
        gone = {p for s in range(len(w) - width + 1) if i is not None and seen[tuple(w[s : s + width])] < i for p in range(s, s + width)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [2, 13])
def test_substrings(spark, width):
    import random

    rng = random.Random(width)
    passage = [" ".join(rng.choices("abcdefgh", k=40)) for _ in range(4)]
    docs = [(i, " ".join(rng.choices("abcdefghijklmnop", k=rng.choice([0, 3, 13, 50]))) + rng.choice(["", "\n" + rng.choice(passage)]) + " x") for i in range(120)]
    got = substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), width)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept") == brute_substrings(docs, width)


def test_substrings_edges(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 1)
    got = substrings.remove_repeats(edge_documents(spark))
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept") == brute_substrings([(i, t) for i, t, _, _ in TEXTS], 13)
    assert substrings.remove_repeats(empty_documents(spark)).count() == 0


def test_suffix_automaton(spark):
    import random

    rng = random.Random(5)
    for _ in range(30):
        texts = [rng.choices("abc", k=rng.randrange(30)) for _ in range(3)]
        probe = rng.choices("abc", k=40)
        has = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        want = [max((n for n in range(e + 2) if n == 0 or tuple(probe[e + 1 - n : e + 1]) in has), default=0) for e in range(len(probe))]
        assert substrings.SuffixAutomaton(texts).matching_statistics(probe) == want
    reference = spark.createDataFrame([("x a b c d y",), (None,)], "text string")
    docs = spark.createDataFrame([(1, "q a b c d z"), (2, "a b"), (3, None)], "doc_id long, text string")
    assert rows_of(substrings.remove_reference(docs, reference, width=3), "doc_id", "n_removed", "kept") == [(1, 4, "q z"), (2, 0, "a b"), (3, 0, "")]
    with pytest.raises(ValueError):
        substrings.remove_reference(docs, reference, max_words=2)


def brute_components(docs, percent=80, size=2):
    sets = []
    for _, t in docs:
        w = SPACED.findall((t or "").translate(FOLD))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    ids = [i for i, _ in docs]
    label = {i: i for i in ids if i is not None}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if ids[a] is not None and ids[b] is not None and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(ids[a]), top(ids[b])
                label[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else top(i)) for i, s in zip(ids, sets, strict=True)), key=repr)


def test_near_duplicates(spark):
    import random

    rng = random.Random(11)
    base = [[f"v{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 5, 6, 40, 120]))] for _ in range(12)]
    docs = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        docs.append((i, " ".join(w).upper() if i % 7 == 0 else "\n".join(w)))
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(docs)
    assert got.where("kept").count() == len({c for _, _, c in brute_components(docs)})


@pytest.mark.parametrize("most", [0, 200_000])
def test_near_duplicates_need_no_stars(spark, monkeypatch, most):
    """Without any star, the comparison of rare buckets alone finds every link, whether buckets are split or not."""
    import random

    rng = random.Random(12)
    docs = []
    for f in range(4):
        base = [f"v{f}x{i}" for i in range((5, 6, 40, 120)[f])]
        family = [base]
        for _ in range(40):
            w = list(rng.choice(family))
            for _ in range(rng.choice([1, 2, 4])):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            family.append(w + rng.choice([[], ["coda"]]))
        docs += [" ".join(w) for w in family]
    docs = list(enumerate(docs))
    none = lambda buckets, *_: buckets.select(F.col("id").alias("c"), F.col("id").alias("m")).where("false")
    monkeypatch.setattr(neardup, "star_edges", none)
    monkeypatch.setattr(neardup, "MOST", most, raising=False)
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    want = brute_components(docs)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == want
    assert len({c for _, _, c in want}) < len(docs) - 40


@pytest.mark.parametrize(("star", "broadcast"), [(200, 1_000_000), (3, 0)])
def test_large_families_lose_no_link(spark, monkeypatch, star, broadcast):
    """Families of over 200 near copies whose links lie about the similarity; large stars are dealt to groups, and no side is broadcast."""
    import random

    monkeypatch.setattr(neardup, "STAR", star)
    monkeypatch.setattr(neardup, "MAX_BROADCAST_ROWS", broadcast)
    rng = random.Random(21)
    docs = []
    for f in range(3):
        base = [f"v{f}x{i}" for i in range((30, 60, 100)[f])]
        for _ in range(210):
            w = list(base)
            for at in rng.sample(range(len(w)), rng.choice([1, 2, 3, 5, 6])):
                w[at] = f"n{rng.randrange(30)}"
            docs.append(" ".join(w))
    docs = list(enumerate(docs))
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(docs)


def test_stored_tables_are_deleted(spark):
    import os

    from millrace.sources import shared

    a = shared.stored(spark.range(3).toDF("n"))
    where = a.stored_path.removeprefix("file:").replace("//", "/")
    assert os.path.isdir(where) and a.count() == 3
    shared.forget(a, spark.range(2))
    assert not os.path.exists(where)


def test_near_duplicates_edges(spark):
    got = neardup.near_duplicates(edge_documents(spark))
    docs = [(i, t) for i, t, _, _ in TEXTS if i != 10]
    assert rows_of(got.where("doc_id is null or doc_id <> 10"), "doc_id", "n_shingles", "component_id") == brute_components(docs)
    assert got.count() == len(TEXTS) and got.where("doc_id is null and not kept").count() == 0
    assert neardup.near_duplicates(empty_documents(spark)).count() == 0


def test_band_keys_are_stable_for_tiny_sets():
    signer = neardup.Signer()
    for text in ("a", "a b", "a b c d e f"):
        s = neardup.shingles(text, 2)
        assert (signer.bands(s) == signer.bands(s)).all() and len(signer.bands(s)) == neardup.BANDS


def test_digest_of_nothing(spark):
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
