"""Language, quality, fertility, privacy, HTML and mixing."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import fertility, html, language, mixing, privacy, quality

from .data import TEXTS, edge_documents, empty_documents, rows_of

VOWELS = {"en": "the and of to in ", "fr": "été les où dès ç ", "de": "der ünd für öl ß "}


def corpus(n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(list(VOWELS))
        words = VOWELS[lang].split()
        rows.append((i, " ".join(rng.choice(words) + rng.choice(["", "a", "on"]) for _ in range(rng.randrange(5, 60))), lang))
    return rows


def test_language_held_out_accuracy(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    out = language.held_out(df["doc_id"], 5, 0)
    model = language.fit(df.where(~out))
    got = language.identify(df, model, keep=["doc_id", "lang"]).where(language.held_out(F.col("doc_id"), 5, 0))
    assert got.count() > 20
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count()
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_edges(spark):
    df = edge_documents(spark)
    model = language.fit(df)
    got = language.identify(df, model, keep=["doc_id", "text"])
    assert got.count() == len(TEXTS)
    und = {r["text"] for r in got.collect() if r["lang_pred"] == "und"}
    assert und == {None, "", " \n\t\r ", "12345 67890 !!! ### $$$"}
    nothing = language.fit(empty_documents(spark))
    assert language.identify(df, nothing).where("lang_pred <> 'und' or score <> 0").count() == 0
    assert language.identify(empty_documents(spark), model).count() == 0


def test_language_ignores_ids_and_labels(spark):
    rows = corpus()
    a = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(a)
    b = spark.createDataFrame([(i + 10_000, t, "xx") for i, t, _ in rows], "doc_id long, text string, lang string")
    assert rows_of(language.identify(a, model, keep=["text"]), "text", "lang_pred", "score") == rows_of(language.identify(b, model, keep=["text"]), "text", "lang_pred", "score")


@pytest.mark.parametrize("limit", [1, 37, 400])
def test_long_text_pieces_add_up(monkeypatch, limit):
    """Wherever a long text is cut, n-grams, words and repeated words count as in the whole text."""
    from millrace.llm import features

    rng = random.Random(limit)
    texts = ["".join(rng.choices("abé \n", k=rng.choice([0, 1, 5, 900]))) + rng.choice(["", " the the  the end", "   "]) for _ in range(40)] + ["x" * 700, None]
    tables = [np.r_[np.random.default_rng(0).normal(size=1 << 10), 0.0].astype(np.float32)]
    whole = features.sums(texts, tables, (1, 2, 3, 4), tables, 10)
    monkeypatch.setattr(features, "LIMIT", limit)
    parts = features.sums(texts, tables, (1, 2, 3, 4), tables, 10)
    assert (whole[1] == parts[1]).all() and np.allclose(whole[0], parts[0])


def brute_bayes(train, texts):
    """Naive Bayes over n-grams of characters themselves; n-grams that a language lacks have the smoothed count."""
    from collections import Counter

    counts = {}
    for text, lang in train:
        counts.setdefault(lang, Counter()).update(text.lower()[i : i + n] for n in language.GRAMS for i in range(len(text) - n + 1))
    size = {x: sum(c.values()) + 0.5 * (1 << language.BITS) for x, c in counts.items()}
    out = []
    for text in texts:
        grams = [text.lower()[i : i + n] for n in language.GRAMS for i in range(len(text) - n + 1)]
        out.append(max(sorted(counts), key=lambda x: sum(math.log((counts[x][g] + 0.5) / size[x]) for g in grams)))
    return out


def test_language_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.held_out(df["doc_id"], 5, 0)
    model = language.fit(df.where(~out))
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(df, model).collect()}
    train = {r["doc_id"] for r in df.where(~out).collect()}
    want = brute_bayes([(t, x) for i, t, x in rows if i in train], [t for _, t, _ in rows])
    # Hashing may join n-grams, which can turn a close case.
    assert sum(got[i] == w for (i, _, _), w in zip(rows, want, strict=True)) >= 0.99 * len(rows)


def test_language_sample_of_rows_without_ids(spark):
    df = spark.createDataFrame([(None, f"text number {i} of many", "en") for i in range(2000)], "doc_id long, text string, lang string")
    _, small = language.fit(df, train_docs=200)
    _, whole = language.fit(df, train_docs=2000)
    assert small.shape == whole.shape and not np.allclose(small, whole)
    with pytest.raises(ValueError):
        language.fit(spark.createDataFrame([(i, "x", f"l{i}") for i in range(language.MAX_LANGUAGES + 1)], "doc_id long, text string, lang string"))


def test_quality_training_against_brute_force():
    """The same steps, one feature and one class at a time, on twenty texts."""
    rng = random.Random(9)
    rows = [(rng.randrange(2), np.array(sorted(rng.sample(range(60), 8)), np.int32), np.array([rng.randrange(1, 4) for _ in range(8)], np.int32)) for _ in range(20)]
    got = quality.train(rows)
    g = np.random.default_rng(0)
    vectors = (g.uniform(-1, 1, (2 << quality.BITS, quality.DIM)) / quality.DIM)[:60].tolist()
    out, bias, step = [[0.0, 0.0] for _ in range(quality.DIM)], [0.0, 0.0], 0
    for _ in range(quality.EPOCHS):
        for i in g.permutation(20):
            y, at, n = rows[i]
            share = [x / sum(n.tolist()) for x in n.tolist()]
            rate = quality.RATE * (1 - step / (20 * quality.EPOCHS))
            step += 1
            mean = [sum(s * vectors[a][d] for a, s in zip(at, share, strict=True)) for d in range(quality.DIM)]
            z = [sum(mean[d] * out[d][c] for d in range(quality.DIM)) + bias[c] for c in (0, 1)]
            p = [math.exp(x) / sum(map(math.exp, z)) - (c == y) for c, x in enumerate(z)]
            back = [sum(out[d][c] * p[c] for c in (0, 1)) for d in range(quality.DIM)]
            for c in (0, 1):
                bias[c] -= rate * 0.1 * p[c]
                for d in range(quality.DIM):
                    out[d][c] -= rate * mean[d] * p[c]
            for a, s in zip(at, share, strict=True):
                for d in range(quality.DIM):
                    vectors[a][d] -= rate * math.sqrt(s) * back[d]
    want = [sum(vectors[a][d] * (out[d][1] - out[d][0]) for d in range(quality.DIM)) for a in range(60)]
    used = sorted({int(a) for _, at, _ in rows for a in at})
    assert np.allclose([got[a] for a in used], [want[a] for a in used], atol=1e-4) and abs(got[-1] - (bias[1] - bias[0])) < 1e-4


def test_quality_sample_is_bounded(spark):
    """Labelled texts are longer than others, and one stands in many rows: the sample stays near its bytes."""
    rows = [(i, "long labelled text " * 200) for i in range(200)] + [(7, "long labelled text " * 200)] * 300 + [(1000 + i, "short") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] * 2, "doc_id long, quality int")
    seen = []
    real, quality.train = quality.train, lambda rows: seen.append(len(rows)) or real(rows)
    try:
        quality.fit(docs, labels, train_bytes=20 * 3800)
        quality.fit(docs, labels)
    finally:
        quality.train = real
    assert 5 <= seen[0] <= 45 and seen[1] == 200


def quality_rows():
    rng = random.Random(2)
    good, bad = "calm clear prose about rivers and hills".split(), "BUY!! $$$ ### NOW!! %%%".split()
    rows, labels = [], []
    for i in range(200):
        y = int(rng.random() < 0.7)
        rows.append((i, " ".join(rng.choices(good if y else bad, k=rng.randrange(8, 60)))))
        labels.append((i, y, 0))
    return rows, labels


def test_quality_separates(spark):
    rows, labels = quality_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([x for x in labels if x[0] % 4 != 2] + [(None, 1, 0), (5000, None, 0)], "doc_id long, quality int, toxic int"))
    score = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    held = [(score[i], y) for i, y, _ in labels if i % 4 == 2]
    assert np.mean([(s >= 0.7) == bool(y) for s, y in held]) > 0.95


def test_quality_edges(spark):
    rows, labels = quality_rows()
    model = quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = quality.score(edge_documents(spark), model)
    assert got.count() == len(TEXTS) and got.where("score is null or score < 0 or score > 1").count() == 0
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    blank = quality.fit(empty_documents(spark).select("doc_id", "text"), no_labels)
    assert quality.score(edge_documents(spark), blank).where("abs(score - 0.5) > 1e-6").count() == 0
    assert quality.score(empty_documents(spark), model).count() == 0


def brute_rules(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = {}
    for s in range(len(words) - 7):
        grams.setdefault(tuple(words[s : s + 8]), []).append(s)
    covered = {p for at in grams.values() if len(at) > 1 for s in at for p in range(s, s + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counting_rules():
    rng = random.Random(4)
    texts = [None, "", "a\na\n\n\n a\na", "x " * 30, "# * $ % & | < >", "é ß \x85 y"] + ["\n".join(" ".join(rng.choices("abc", k=rng.randrange(14))) for _ in range(rng.randrange(9))) for _ in range(200)]
    for t in texts:
        assert fertility.counting_rules(t or "") == brute_rules(t)


def test_fertility_edges(spark):
    got = fertility.quality_rules(edge_documents(spark))
    by = sorted(((i, *brute_rules(t)) for i, t, _, _ in TEXTS), key=repr)
    assert rows_of(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == by
    assert got.where("base_failed and kept").count() == 0
    assert fertility.quality_rules(empty_documents(spark)).count() == 0


def test_fertility_bands():
    assert fertility.script("hello") == "latin" and fertility.script("привет мир") == "cyrillic" and fertility.script("12 !") == "none" and fertility.script("漢字かな") == "cjk"
    assert fertility.verdict("latin", 500, 2.5, 0.0, 6.0) and not fertility.verdict("latin", 500, 1.0, 0.0, 6.0)
    assert not fertility.verdict("latin", 500, 2.5, 0.5, 6.0) and not fertility.verdict("latin", 500, 2.5, 0.0, 1.0) and not fertility.verdict("none", 5, 1.0, 0.0, 1.0)


def vocabularies():
    import public_tokenizers as public

    with open(public.path("piece_bpe_32k.model"), "rb") as a, open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as b:
        return [fertility.PieceVocabulary(a.read()), fertility.PairVocabulary(b.read(), public.PATTERN)]


WORDS = "river mountain calm evening under the old bridge walked slowly a man and his dog thought about weather that had been good for many days while children played near water with small boats made of paper so nobody heard when first rain came down over fields where farmers still worked until dark then everyone went home".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_fertility_against_brute_force(spark):
    """Tokens, shares, entropy, bands and kept of every text, worked out one by one; junk falls out of the bands of its language."""
    from collections import Counter

    rng = random.Random(8)
    docs = [(i, prose(rng, rng.randrange(60, 120)), "en") for i in range(80)] + [(100 + i, prose(rng, 80), None) for i in range(5)]
    docs += [(200, " ".join(w + rng.choice(["$$$", "%%%", "***"]) for w in prose(rng, 90).split()), "en"), (201, " | ".join(prose(rng, 70).split()), "en"), (202, "тихий вечер под старым мостом " * 2, "ru"), (203, None, "en"), (204, "漢" * 300, "zh")]
    own = vocabularies()
    rows, groups = {}, {}
    for i, text, lang in docs:
        text, found = text or "", []
        for v in own:
            ids = v.ids(text).tolist()
            counts = Counter(ids).values()
            entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts)
            found.append((len(ids), len(text) / len(ids) if ids else 0.0, sum(bool(v.byte[x]) for x in ids) / len(ids) if ids else 0.0, entropy if ids else 0.0))
        counts = brute_rules(text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        values = [round(x, 3) for x in (found[0][1], found[1][1], found[0][3], found[1][3])]
        group = (lang or "script " + fertility.script(text), math.floor(math.log2(max(found[0][0], 1))))
        rows[i] = (found, failed, values, group, all(fertility.verdict(fertility.script(text), *x) for x in found))
        if not failed:
            groups.setdefault(group, []).append(values)
    bands = {g: [np.percentile([x[k] for x in v], [25, 75]) for k in range(4)] for g, v in groups.items() if len(v) >= fertility.MIN_GROUP}
    got = {r["doc_id"]: r for r in fertility.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string"), language="lang").collect()}
    for i, (found, failed, values, group, inside) in rows.items():
        for k, (low, high) in enumerate(bands.get(group, ())):
            inside = inside and values[k] >= low - 3 * (high - low) - 1e-9 and (k > 1 or values[k] <= high + 3 * (high - low) + 1e-9)
        r = got[i]
        assert (r["n_tokens"], r["n_pair_tokens"], r["base_failed"], r["kept"]) == (found[0][0], found[1][0], failed, inside and not failed)
        want = [x for f in found for x in f[1:]]
        assert np.allclose([r[c] for c in ("chars_per_token", "fallback_share", "token_entropy", "chars_per_pair", "pair_fallback_share", "pair_entropy")], want)
    assert not got[200]["kept"] and not got[201]["kept"] and not got[200]["base_failed"] and sum(got[i]["kept"] for i in range(80)) >= 76


def test_long_texts_tokenize_as_whole(monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, 400), "x" * 900, "漢字" * 400, "a  b   c\n\n d " * 100, prose(rng, 50) + "é" * 300 + " ñandú " + prose(rng, 50)]
    own = vocabularies()
    whole = [fertility.fertility(v, t) for v in own for t in texts]
    monkeypatch.setattr(fertility, "PIECE_CHARS", 100)
    assert [fertility.fertility(v, t) for v in own for t in texts] == whole


def brute_spans(text):
    import re

    kinds = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    out = []
    for k, p in enumerate(kinds):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split(".")) or k == 2 and 14 <= len(digits) <= 19 and privacy.luhn(digits) or k == 3 and 10 <= len(digits) <= 15
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans():
    rng = random.Random(6)
    texts = ["a@b.c", "a@b@c.d.e@f.g", "x..y@z-.q. 1.2.3.4.5.6.7.8", "4539 1488 0343 6467, 4539148803436467 +1 (555) 010-0199", "é" * 5 + "u.v@w.xy", "+49 30 1234567-8", "256.1.1.1 0001.2.3.4"]
    texts += ["".join(rng.choices("ab@.-+1 05(", k=rng.randrange(60))) for _ in range(3000)]
    for t in texts:
        assert privacy.base_spans(t) == brute_spans(t), t


def test_disclosing_terms(spark):
    things = [a + b for a in ("ba", "ce", "di", "fo", "gu", "hy", "ka") for b in ("rk", "st", "nd", "lm", "sh", "mp", "ct")]
    docs = [(i, f"Note {i}: the {w} spoke, write to spy{'' if i < 6 else i}@hq.example.org about {things[i]} plan number {i}") for i, w in enumerate(["Falconer"] * 6 + ["teacher", "doctor", "sailor", "farmer"] * 10)]
    docs += [(100 + i, f"a common day with common words number {i}") for i in range(60)] + [(999, None), (None, "x")]
    got = {r["doc_id"]: r for r in privacy.sanitise(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0]["n_term"] == 1 and "[TERM]" in got[0]["redacted"] and "[EMAIL]" in got[0]["redacted"] and "Falconer" not in got[0]["redacted"]
    assert got[8]["n_term"] == 0 and "sailor" in got[8]["redacted"]
    assert got[100]["redacted"] == docs[46][1] and got[999]["redacted"] is None
    wide = privacy.sanitise(spark.createDataFrame(docs, "doc_id long, text string"), broadcast_rows=0)
    assert {r["doc_id"]: r["spans"] for r in wide.collect()} == {i: r["spans"] for i, r in got.items()}


ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth".split()


def test_copies_do_not_hide_disclosing_terms(spark):
    docs = [f"the {w} letter to spy@hq.example.org from Falconer" for w in ORDINALS[:5]] + [f"a common day with common words number {i}" for i in range(60)]
    docs += docs[:1] * 200
    got = privacy.sanitise(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    wide = privacy.sanitise(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), broadcast_rows=0)
    for rows in (got.collect(), wide.collect()):
        assert all(("[EMAIL]" in r["redacted"]) == ("[TERM]" in r["redacted"]) and "Falconer" not in r["redacted"] for r in rows)


def test_disclosure_alone_decides_in_varied_and_few_contexts(spark):
    docs = [f"the {w} letter to spy@hq.example.org from {'Falconer' if i < 4 else 'someone'}" for i, w in enumerate(ORDINALS)]
    docs += [f"the {w} note to agent@hq.example.org from Kestrel" for w in ORDINALS[:2]]
    docs += ["a single note to lone@hq.example.org from Merlin and Osprey", "later Merlin left"]
    docs += [f"a common day, note and letter from someone to the {w} common word" for w in ORDINALS * 6]
    docs = [f"{t} {i}" for i, t in enumerate(docs)]
    got = [r["redacted"] for r in privacy.sanitise(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert not any(w in t for t in got[:12] for w in ("Falconer", "Kestrel"))
    assert "Osprey" in got[12] and got[13] == docs[13] and all("[TERM]" not in t for t in got[4:10])


def brute_disclosure(docs):
    """Mutual information of every entity and term near it, from the definition, over distinct texts."""
    texts = sorted({t for _, t in docs if t is not None})
    seen = {}
    for t in texts:
        for a, k, b in privacy.base_spans(t):
            terms = privacy.context(t, a, b)
            e = seen.setdefault(privacy.entity(t, a, k, b), {"texts": set(), "contexts": set(), "terms": {}})
            e["texts"].add(t)
            e["contexts"].add(tuple(terms))
            for x in set(terms):
                own = e["terms"].setdefault(x, (set(), set()))
                own[0].add(t)
                own[1].add(tuple(terms))
    n, out = len(texts), set()
    for name, e in seen.items():
        information = math.log2(n / len(e["texts"]))
        for x, (together, shared) in e["terms"].items():
            holds = sum(x in privacy.TERM.findall(t.lower()) for t in texts)
            if len(shared) < min(3, len(e["contexts"])) or len(e["contexts"]) == 1 and holds == 1 or information <= 0:
                continue
            if math.log2(len(together) * n / (len(e["texts"]) * holds)) >= privacy.MIN_DISCLOSURE * information - 1e-12:
                out.add((name, x))
    return out


def test_disclosure_against_brute_force(spark):
    rng = random.Random(13)
    names = [f"{a}{b}" for a in ("Fal", "Kes", "Mer", "Osp") for b in ("con", "trel", "lin", "rey")]
    places = [f"{a}{b}" for a in ("nor", "sud", "est", "wes") for b in ("ville", "stadt", "ham")]
    docs = []
    for i in range(260):
        who = rng.randrange(16)
        text = f"{rng.choice(['the', 'das', 'le'])} letter {rng.choice(places)} of {names[who] if rng.random() < 0.8 else 'nobody'} to p{who}@hq.example.org cafe\u0301 {rng.choice(places)} \u0939\u093f\u0928\u094d\u0926\u0940"
        docs.append((i, text if i % 3 else f"{rng.choice(places)} {rng.choice(names)} {rng.choice(places)} note {i % 7}"))
    docs += docs[:20] * 3 + [(None, None), (999, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_disclosure(docs)
    assert len(want) > 5
    for rows in (200_000, 0):
        assert {tuple(r) for r in privacy.disclosing_terms(df, rows).collect()} == want


def test_privacy_edges(spark):
    got = privacy.sanitise(edge_documents(spark), keep=["doc_id"])
    assert got.count() == len(TEXTS)
    assert privacy.sanitise(empty_documents(spark)).count() == 0


PAGE = "<html><head><title>t</title><style>p{}</style></head><body><nav><a>menu</a></nav><div class='cookie-notice'>ok?</div><article><h1>A &amp; B</h1><p>one <b>two<br>three<p>four&nbsp;\n five</p><aside>side</aside><form>f</form><script>x('</p>')</script><div id=comments>meh</div></article><footer>f</footer></body></html>"


def test_main_text():
    assert html.main_text(PAGE) == "A & B\none two three\nfour five"
    assert html.main_text(None) == html.main_text("") == ""
    assert html.main_text("<p>open <i>never closed") == "open never closed"
    assert html.main_text("plain &lt;text&gt;") == "plain <text>"
    assert html.main_text("<!-- c --><article>a<!-- <p>b</p> --></article>") == "a"
    assert html.main_text("<article><p>x</article>y<article>z</article>") == "x\nz"
    wrapped = "<div class='page with-sidebar'><article><header><h1>T</h1></header><p>x</p></article><div class='sidebar'>s</div></div>"
    assert html.main_text(wrapped) == "T\nx"
    assert html.main_text("<article>x</article><div class=related><article>teaser</article></div>") == "x"


def test_site_templates(spark):
    def page(i, host):
        return (i, f"https://{host}/p/{i}", f"<body><div class=x><p>Join our club</p></div><div><p>story {i} of {host}</p></div></body>", "extra")

    rows = [page(i, "h.org") for i in range(30)] + [page(100 + i, f"o{i}.net") for i in range(5)] + [(900, None, None, "x"), (901, "https://h.org/z", "", "x"), (None, "https://h.org/z", "<p>q", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host_ string")
    got = {r["page_id"]: r["text"] for r in html.extract_pages(df).collect()}
    assert got[3] == "story 3 of h.org" and got[101] == "Join our club\nstory 101 of o1.net" and got[900] == got[901] == "" and got[None] == "q"
    joined = {r["page_id"]: r["text"] for r in html.extract_pages(df, broadcast_rows=0).collect()}
    assert joined == got
    assert html.extract_pages(df.limit(0)).count() == 0


def test_article_paragraphs_are_never_templates(spark):
    rows = [(i, "https://h.org/", "<article><p>same</p><p>text</p></article>") for i in range(40)]
    got = html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r["text"] for r in got.collect()} == {"same\ntext"}


def test_copied_pages_keep_their_text(spark):
    pages = ["<body><div id=page><article><p>copied story</p></article></div></body>", "<body><div><p>copied body</p></div></body>"]
    rows = [(i, f"https://h.org/{i}", pages[i % 2]) for i in range(40)]
    rows += [(100 + i, f"https://w.org/{i}", f"<body><div id=page><article><p>same story</p></article></div><!-- {i} --></body>") for i in range(40)]
    got = html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {(r["page_id"] % 2 if r["page_id"] < 100 else 2, r["text"]) for r in got.collect()} == {(0, "copied story"), (1, "copied body"), (2, "same story")}


def test_templates_alone_remove_boilerplate(spark):
    """Without names, what recurs on a host goes: menus, notices beside the article, and advert containers inside it; its text blocks stay."""

    def page(i, host):
        menu = f"<div data-n='{i}'><ul><li><a href='/{i}'>Home</a></li><li><a href='/a?{i}'>About</a></li></ul></div>"
        advert = f"<div id='x{i}'><span>Buy now at half price</span></div>"
        return (i, f"https://{host}/{i}", f"<body>{menu}<article><h1>Title {i}</h1><p>Our usual greeting.</p><p>Body of story {i} goes on for a while.</p>{advert}</article><section>Accept all</section></body>")

    rows = [page(i, "big.org") for i in range(30)] + [page(100 + i, "small.org") for i in range(3)] + [page(0, "big.org")] * 2
    df = spark.createDataFrame([(*r, "text", "host") for r in rows], "page_id long, url string, html string, text string, host string")
    got = html.extract_pages(df, names=False).collect()
    assert len(got) == len(rows)
    for r in got:
        story = f"Title {r['page_id']}\nOur usual greeting.\nBody of story {r['page_id']} goes on for a while."
        assert r["text"] == (story if r["page_id"] < 100 else story + "\nBuy now at half price")
    bare = [(r[0], r[1], r[2].replace("article>", "div>")) for r in rows]
    got = html.extract_pages(spark.createDataFrame(bare, "page_id long, url string, html string"), names=False).where("page_id < 100").collect()
    assert not any("Home" in r["text"] or "Accept" in r["text"] for r in got) and all(f"Body of story {r['page_id']} " in r["text"] for r in got)


def test_one_article_under_many_titles_is_no_template(spark):
    rows = [(i, f"https://h.org/{i}", f"<article><h1>Number {i}</h1><div>the same long body of one story that runs on</div></article>") for i in range(40)]
    got = html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r["text"] for r in got.collect()} == {f"Number {i}\nthe same long body of one story that runs on" for i in range(40)}


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<a x='", "<div>", "</p>", "<div class=ad><article>", "<!--", "<", "</", "<script>", "<title></title x", "<article><div>x", "<p title=''>", "&amp"])
def test_hostile_pages_cost_what_their_length_does(piece):
    import time

    began = time.perf_counter()
    html.main_text(piece * (200_000 // len(piece)) + "</p>" * 20_000 + "</div>" * 20_000, frozenset({1}))
    assert time.perf_counter() - began < 10


def brute_schedule(weights, blocks):
    """Earliest deadline first, slot by slot over all sources."""
    done, left, out, end = dict.fromkeys(blocks, 0), sorted(s for s in blocks if blocks[s]), [], None
    while left:
        total = sum(weights[s] for s in left)
        first, base = dict(done), len(out)
        while all(done[s] < blocks[s] for s in left):
            slot = len(out) - base
            released = [s for s in left if math.floor((done[s] - first[s]) * total / weights[s]) <= slot]
            s = min(released, key=lambda x: (math.ceil((done[x] - first[x] + 1) * total / weights[x]), x))
            out.append((s, done[s]))
            done[s] += 1
        left = [s for s in left if done[s] < blocks[s]]
        end = len(out) if end is None else end
    return out, end


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 3.3, "c": 1.1, "d": 0.01}, {str(i): 1 + i % 3 for i in range(40)}, {"a": 2**0.5, "b": 3**0.5, "c": 1e-7}])
def test_pfair_deviation_is_below_one_block(weights):
    weights = {s: Fraction(w) for s, w in weights.items()}
    blocks = {s: 30 + 60 * i for i, s in enumerate(weights)}
    got, end = mixing.pfair_schedule(weights, blocks)
    assert sorted(got) == sorted((s, k) for s, n in blocks.items() for k in range(n))
    assert (got, end) == brute_schedule(weights, blocks)
    done, total = dict.fromkeys(weights, 0), sum(weights.values())
    for t, (s, _) in enumerate(got[:end], 1):
        done[s] += 1
        assert all(abs(done[x] - weights[x] / total * t) < 1 for x in weights)


def test_pfair_deviation_stays_below_one_block_on_long_schedules():
    weights = {"a": Fraction(2**0.5), "b": Fraction(1), "c": Fraction(0.001)}
    got, end = mixing.pfair_schedule(weights, {"a": 60_000, "b": 45_000, "c": 500})
    done, total = dict.fromkeys(weights, 0), sum(weights.values())
    for t, (s, _) in enumerate(got[:end], 1):
        done[s] += 1
        assert abs(done[s] - weights[s] / total * t) < 1


def test_mix_places_every_row(spark):
    rows = [(i, "x" * (i % 50), "abc"[i % 7 % 3], i) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, slot long").drop("slot")
    got = mixing.mix(df, {"a": 0.6, "b": 0.3, "c": 0.1}, block_chars=500).toPandas()
    assert sorted(got.doc_id) == list(range(3000))
    slots = got.groupby("slot").source.nunique()
    assert (slots == 1).all()  # a slot belongs to one block
    chars = {s: sum(len(t) for _, t, x, _ in rows if x == s) for s in "abc"}
    want, end = brute_schedule({"a": Fraction(0.6).limit_denominator(10**9), "b": Fraction(0.3).limit_denominator(10**9), "c": Fraction(0.1).limit_denominator(10**9)}, {s: -(-n // 500) for s, n in chars.items()})
    at = {x: i for i, x in enumerate(want)}
    assert all(at[r.source, r.block] == r.slot and (r.slot < end) == r.in_mix for r in got.itertuples())
    for _, own in got.sort_values(["block", "place"]).groupby("source"):
        assert own.slot.is_monotonic_increasing


@pytest.mark.parametrize("weights", [None, {"s1": 3.0, "s2": 1.0, "s70": 2.0}])
def test_many_sources_share_a_pool(spark, monkeypatch, weights):
    monkeypatch.setattr(mixing, "PART_ROWS", 50)
    monkeypatch.setattr(mixing, "MAX_BLOCKS", 200)
    rows = [(i, "x" * (1 + i % 9), f"s{i % 80 if i % 2 else i % 3}") for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights, block_chars=10, max_sources=5).toPandas()
    assert sorted(got.doc_id) == list(range(4000))
    assert got.slot.max() < 205 and (got.groupby("slot").source.nunique() > 1).any()


def test_mix_of_repeated_rows(spark):
    df = spark.createDataFrame([(7, "same text", "a")] * 30 + [(None, "same text", None)] * 20 + [(8, None, "b"), (8, "", "b")], "doc_id long, text string, source string")
    got = mixing.mix(df, block_chars=20).toPandas()
    assert len(got) == 52 and got.slot.notna().all() and got[got.source == "a"].block.nunique() == 14


def test_mix_edges(spark):
    got = mixing.mix(edge_documents(spark).drop("slot"))
    assert got.count() == len(TEXTS) and got.where("slot is null").count() == 0
    assert mixing.mix(empty_documents(spark).drop("slot")).count() == 0


@pytest.mark.parametrize("weights,most", [(None, 200), ({"s1": 3.0, "s2": 1.0, "s70": 2.0, "none": 5.0}, 200), (None, 12)])
def test_every_source_of_many_has_blocks_of_its_own(spark, monkeypatch, weights, most):
    for name, value in (("PART_ROWS", 50), ("MAX_BLOCKS", most), ("MAX_SOURCES", 5), ("GROUP_SOURCES", 30), ("SMALL", 10)):
        monkeypatch.setattr(mixing, name, value)
    rows = [(i, "x" * (1 + i % 9), f"s{i % 80 if i % 2 else i % 3}") for i in range(4000)]
    rows += [(4000, None, "s1"), (4001, "", None)] + [(4002 + i, "y" * 90, f"t{i % 4}") for i in range(200)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights, block_chars=10).toPandas()
    assert sorted(got.doc_id) == list(range(4202))
    got["source"] = got.source.fillna("")
    assert (got.groupby("slot")[["source", "block"]].nunique() == 1).all().all()
    chars = Counter()
    for _, text, source in rows:
        chars[source or ""] += len(text or "")
    size = max(10, -(-sum(chars.values()) // most))
    blocks = {s: -(-max(n, 1) // size) for s, n in chars.items()}
    for s, own in got.groupby("source"):
        assert own.block.max() < blocks[s] and own.sort_values(["block", "place"]).slot.is_monotonic_increasing
        held = {k: x for k, x in zip(own.block, own.place + own.block * size)}
        assert all(k == min(x // size, blocks[s] - 1) for k, x in held.items())
    assert got.slot.max() < 2 * most + 2 * len(blocks)
    if most == 12:
        return
    # Slots are those of blocks, so a source's share at the end of the mix is that of its blocks: within two of its target.
    target = {s: max(n, 1) ** 0.5 if weights is None else weights.get(s, 1.0) for s, n in chars.items()}
    end, total = got[got.in_mix].slot.max() + 1, sum(target.values())
    own = got[got.in_mix].groupby("source").block.max()
    assert end > (20 if weights is None else 1)
    for s in blocks:
        assert abs(own.get(s, -1) + 1 - target[s] / total * end) < 2


def test_schedule_of_many_sources_ends():
    weights = mixing._fractions({str(i): (1 + i) ** 0.5 for i in range(1500)})
    got, _ = mixing.pfair_schedule(weights, {s: 1 + i % 2 for i, s in enumerate(weights)})
    assert len(got) == 2250 and len(set(got)) == 2250
