"""Language, toxicity and quality: held-out accuracy, and defined results for odd rows."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from docengine.llm import langid, quality, toxicity
from docengine.llm.lm import fold

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    return dict(zip(t["doc_id"], zip(t["text"], t["lang"], strict=True), strict=True))


def split(ids):
    return [i for i in ids if fold(i, 5) != 0], [i for i in ids if fold(i, 5) == 0]


@pytest.fixture(scope="module")
def field(docs):
    own, _ = split(docs)
    own = own[:300]
    return langid.fit(pa.array([docs[i][0] for i in own]), [docs[i][1] for i in own], sorted({docs[i][1] for i in own}))


def test_language_accuracy(docs, field):
    _, held = split(docs)
    got, score = langid.predict(field, pa.array([docs[i][0] for i in held]))
    assert sum(a == docs[i][1] for a, i in zip(got, held, strict=True)) >= 0.95 * len(held)
    assert (score >= 0).all() and (score <= 1).all()


def test_code_switched_words(docs, field):
    by = {lang: next(t for t, x in docs.values() if x == lang and len(t) > 300)[:150] for lang in ("de", "en")}
    runs = langid.label_words(field, by["de"] + " " + by["en"])
    size = {lang: sum(len(w) for x, w in runs if x == lang) for lang in ("de", "en")}
    assert min(size.values()) > 90 and runs[0][0] == "de" and runs[-1][0] == "en"


def test_letterless_texts(field):
    got, score = langid.predict(field, pa.array(["", None, "123 !!", "— · …", "東京", "x" * 300_000]))
    assert got[:4] == ["und"] * 4 and not score[:4].any() and got[4] != "und"
    assert langid.predict(langid.CrfModel([], field.weights[:, :0], field.moves[:0, :0], field.start[:0]), pa.array(["text"]))[0] == ["und"]


def test_recursions_agree_with_enumeration(field):
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    e, move, start = rng.normal(size=(1, 4, 3)), np.exp(rng.normal(size=(3, 3))), np.exp(rng.normal(size=3))
    marg, _, _ = langid._forward_backward(e, move, start)
    want = np.zeros((4, 3))
    for p in itertools.product(range(3), repeat=4):
        w = start[p[0]] * np.exp(sum(e[0, t, s] for t, s in enumerate(p))) * np.prod([move[a, b] for a, b in zip(p, p[1:])])
        for t, s in enumerate(p):
            want[t, s] += w
    assert np.allclose(marg[0], want / want.sum(1, keepdims=True))


@pytest.fixture(scope="module")
def labelled(docs):
    t = pq.read_table(f"{SF}/labels.parquet").to_pydict()
    return {i: (q, x) for i, q, x in zip(t["doc_id"], t["quality"], t["toxic"], strict=True) if i in docs}


def test_toxicity(docs, labelled):
    own, held = split(labelled)
    m = toxicity.fit(pa.array([docs[i][0] for i in own]), [labelled[i][1] for i in own])
    p = toxicity.predict(m, pa.array([docs[i][0] for i in held]))
    assert sum((a >= 0.5) == labelled[i][1] for a, i in zip(p, held, strict=True)) >= 0.93 * len(held)
    clean = "the of and in the on"
    base = toxicity.predict(m, pa.array([clean, "", None]))
    assert (base < 0.5).all()
    for w in ("idiot", "1d10t", "i d i o t", "i-d-i-o-t", "idiooooot", "w0rthless", "m0r0n"):
        assert toxicity.predict(m, pa.array([f"{clean} {w} {clean}"]))[0] > 3 * base[0], w
    assert toxicity.restored_text(m, "The 1d10t, and M0R0N!") == "the idiot, and moron!"
    assert (toxicity.predict(toxicity.fit(pa.array([], pa.string()), []), pa.array(["x", None])) == 0.5).all()


def test_quality(docs, labelled):
    own, held = split(labelled)
    m = quality.fit(pa.array([docs[i][0] for i in own]), [labelled[i][0] for i in own])
    p = quality.predict(m, pa.array([docs[i][0] for i in held]))
    assert sum((a >= 0.3) == labelled[i][0] for a, i in zip(p, held, strict=True)) >= 0.93 * len(held)
    odd = quality.predict(m, pa.array(["", None, "x " * 100_000]))
    assert ((odd >= 0) & (odd <= 1)).all() and odd[0] == odd[1]
    assert (quality.predict(quality.fit(pa.array([], pa.string()), []), pa.array(["x", None])) == 0.5).all()


def test_reports_over_odd_tables(spark):
    docs = spark.createDataFrame([(1, "der die und", "de", 1), (2, "the of and", "en", 1), (2, "the of and", "en", 1), (3, None, None, 1), (None, "le la", "fr", 1)], "doc_id long, text string, lang string, score int")
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (2, 1, 0), (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    none, nothing = docs.limit(0), labels.limit(0)
    for report in (lambda d, y: langid.language_report(spark, d), lambda d, y: toxicity.toxicity_report(spark, d, y), lambda d, y: quality.quality_report(spark, d, y)):
        rows = report(docs, labels).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert report(none, nothing).collect() == []
    assert {r.predicted for r in toxicity.toxicity_report(spark, docs, nothing).collect()} == {1}


def test_long_tokens_and_runs_are_restored(docs, labelled):
    own, _ = split(labelled)
    m = toxicity.fit(pa.array([docs[i][0] for i in own]), [labelled[i][1] for i in own])
    clean = "the of and in the on"
    base = toxicity.predict(m, pa.array([clean]))[0]
    spelled = " ".join("theoftheofandintheonthe" + "idiot" + "andtheoftheinandtheofonthe")
    assert len(spelled.split()) > 48
    for w in ("i" + "d" * 60 + "iot", "i-" + "-" * 50 + "d-i-o-t", "1" + "d" * 5000 + "10t", spelled):
        assert toxicity.predict(m, pa.array([f"{clean} {w} {clean}"]))[0] > 3 * base, w[:60]
    assert toxicity.restored_text(m, "The i" + "d" * 60 + "iot!") == "the idiot!"
    assert toxicity.restored_text(m, " ".join("idiot" * 12)) == "idiot" * 12


@pytest.mark.parametrize("letters", [11, 15, 30, 44, 46, 48, 49, 50, 60, 500])
def test_words_in_runs_are_found_at_every_length(docs, labelled, letters):
    """A spelled-out run that ends in a word, and one joined by signs: no length is another case."""
    own, _ = split(labelled)
    m = toxicity.fit(pa.array([docs[i][0] for i in own]), [labelled[i][1] for i in own])
    base = toxicity.predict(m, pa.array(["the of and"]))[0]
    run = ("theofandin" * 60)[: letters - 5] + "idiot"
    assert toxicity.predict(m, pa.array([" ".join(run)]))[0] > 3 * base
    assert toxicity.predict(m, pa.array(["-".join(run)]))[0] > 3 * base


@pytest.mark.parametrize("length", [300, 60_000])
def test_long_labelled_texts_are_learned_from(spark, length):
    """Labelled rows of long texts alone give scores on both sides of a half; with a small budget the shortest are taken."""
    from docengine.llm.labelled import labelled_sample

    pad = "plain words of no kind " * (length // 23)
    docs = spark.createDataFrame([(i, f"{pad} {'stupid idiot' if i % 2 else 'kind friend'}") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(80)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_report(spark, docs, labels).collect()
    assert all((r["score"] >= 0.5) == bool(r["doc_id"] % 2) for r in got)
    texts, y = labelled_sample(spark, docs, labels, "toxic", 4000, most=1600)
    assert len(texts) == 16 and sum(y) == 8


def test_word_marginals_agree_with_enumeration(field):
    """What predicts, over a batch of texts of several lengths, against all paths of each text alone."""
    import itertools

    import numpy as np

    from docengine.llm.shared import string_buffers
    from docengine.llm.textkit import span_hashes

    texts = ["der the und", "", "le", "the house und das haus", "xyzzy la la", "123 a"]
    k = len(field.langs)
    _, _, docs, got = langid.word_marginals(field, *string_buffers(pa.array(texts)))
    for d, text in enumerate(texts):
        st, en, _, data = langid._words(*string_buffers(pa.array([text])))
        if not len(st):
            assert not (docs == d).any()
            continue
        e = langid._emissions(field.weights, *langid._features(data, st, en), langid._lexicon_hits(field.lexicon, span_hashes(data, st, en))).astype(float)
        want = np.zeros((len(st), k))
        for p in itertools.product(range(k), repeat=len(st)):
            w = np.exp(field.start[p[0]] + sum(e[t, s] for t, s in enumerate(p)) + sum(field.moves[a, b] for a, b in zip(p, p[1:])))
            for t, s in enumerate(p):
                want[t, s] += w
        assert np.allclose(got[docs == d], want / want.sum(1, keepdims=True), atol=1e-5), text


def _exhaustive(model, token):
    """The best plain form over all paths of a token's lattice, none left out."""
    paths = [(0.0, "^^", "")]
    for i, c in enumerate(token):
        nxt = []
        for p, state, w in paths:
            moves = [(state[1] + x, (0.0 if c.isalpha() else -0.7) + model.chars.get(state + x, model.floor), x) for x in toxicity.STANDS_FOR.get(c) or (c if c.isalpha() else "")]
            if c in toxicity.BETWEEN or not c.isalnum():
                moves.append((state, -0.5, ""))
            elif c.isalpha() and state[1] == c and i and token[i - 1] == c:
                moves.append((state, -1.0, ""))
            nxt += [(p + cost, to, w + x) for to, cost, x in moves or [(state, -3.0, "")]]
        paths = nxt
    ends = [(p + model.chars.get(s + "^", model.floor), w) for p, s, w in paths]
    return max(((max(p, model.known.get(w, -1e9)) + (8.0 if w in model.known else 0.0), w) for p, w in ends), default=(0.0, ""))


def test_search_is_exact_at_full_width(monkeypatch):
    """Nothing is cut: the recursion over states equals the search over all paths, under any model."""
    import random

    monkeypatch.setattr(toxicity, "BEST", 10**6)
    rng = random.Random(3)
    letters = "^ideotasl"
    model = toxicity.ToxicModel(chars={a + b + c: -rng.random() * 5 for a in letters for b in letters for c in letters})
    model.known = {"idiot": -3.0, "toad": -4.0, "is": -2.0, "so": -2.5}
    tokens = ["1d10t", "i-d-i-o-t", "t0@d", "50", "1$", "!d!0t", "idiooot"] + ["".join(rng.choice("id0o1ts@-a!") for _ in range(rng.randrange(1, 8))) for _ in range(300)]
    for t in tokens:
        assert toxicity.restore(model, t) == _exhaustive(model, t)[1], t
    assert toxicity.restore(model, "1d10t") == "idiot"


def test_beam_loses_little_under_a_learned_model(docs, labelled):
    import random

    own, _ = split(labelled)
    m = toxicity.fit(pa.array([docs[i][0] for i in own]), [labelled[i][1] for i in own])
    rng = random.Random(4)
    signs = {"o": "0", "i": "1!|", "l": "1|", "e": "3", "a": "4@", "s": "5$", "t": "7+", "g": "69", "b": "8"}
    words = rng.sample(sorted(w for w in m.known if 4 <= len(w) <= 8 and w.isascii()), 300)
    tokens = ["".join(rng.choice(signs[c]) if c in signs and rng.random() < 0.7 else c + rng.choice(["", "", "", "-", c]) for c in w) for w in words]
    same = sum(toxicity.restore(m, t) == _exhaustive(m, t)[1] for t in tokens)
    assert same >= 0.99 * len(tokens), same


def test_quality_equals_plain_pooling_and_forward_pass(docs, labelled):
    """Every input and the network once more, a word at a time."""
    import math
    import re

    import numpy as np

    from docengine.llm.textkit import span_hashes

    own, held = split(labelled)
    m = quality.fit(pa.array([docs[i][0] for i in own[:200]]), [labelled[i][0] for i in own[:200]])
    texts = ["", " ", "one", "The THE the cat, 12 cats!", "a a a a b", *(docs[i][0][:3000] for i in held[:20])]
    one = lambda b: span_hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))
    want = []
    for text in texts:
        tokens = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda c: c[0].lower(), text.encode()))
        x = np.zeros(3 * quality.DIM + 4)
        x[-4] = math.log1p(len(tokens))
        v, s, known, equal = [], [], 0, 0
        for i, t in enumerate(tokens):
            shape = re.sub(rb"(?s)(.)\1+", rb"\1", re.sub(rb"[0-9]", b"0", re.sub(rb"[A-Za-z\x80-\xff]", b"a", t)))
            s.append(quality.index_vectors(one(shape))[0])
            at = np.flatnonzero(m.hashes == one(t))
            v.append(m.vectors[at[0]] if len(at) else s[-1])
            known += len(at)
            equal += i > 0 and t == tokens[i - 1]
        if tokens:
            n = len(tokens)
            x[: quality.DIM] = sum(v) / n
            x[quality.DIM : 2 * quality.DIM] = sum(s) / n
            x[2 * quality.DIM : 3 * quality.DIM] = sum((a * b for a, b in zip(v, v[1:])), np.zeros(quality.DIM)) / n
            x[-3:] = equal / n, known / n, len(text.encode()) / n / 10
        x = (x - m.mean) / m.spread
        w, b, w2, b2 = m.layers
        hidden = [max(0.0, float(sum(x * w[:, j]) + b[j])) for j in range(w.shape[1])]
        want.append(1 / (1 + math.exp(-(sum(h * q for h, q in zip(hidden, w2)) + float(b2)) / m.temperature)))
    assert np.allclose(quality.predict(m, pa.array(texts)), want, atol=1e-4)


def test_toxic_language_model_counts_every_labelled_row(spark):
    texts = ["plain words Again", "again plain", "rare bad word again plain", "", None, "held plain"] + ["some more words again"] * 30
    ids = [i for i in range(200) if fold(i, 5) != 0][: len(texts) - 1]
    ids.insert(5, next(i for i in range(200) if fold(i, 5) == 0))
    y = [0, 0, 1, 0, 1, 1] + [i % 2 for i in range(30)]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(list(zip(ids, y, strict=True)), "doc_id long, toxic int")
    got = toxicity.train_language_model(spark, docs, labels)
    own = [k for k in range(len(texts)) if k != 5]
    want = toxicity._language_model([(texts[k] or "").lower() for k in own], [y[k] for k in own])
    assert got.known == pytest.approx(want.known) and got.chars == pytest.approx(want.chars) and got.longest == want.longest


def test_only_labelled_texts_are_moved(spark):
    """Bytes shuffled for the labelled texts: few of those of all texts, and as many whether Spark may broadcast or not."""
    import random

    rng = random.Random(1)
    ids = [i for i in range(3000) if fold(i, 5) != 0]
    texts = {i: "".join(chr(rng.randrange(0x4E00, 0x9E00)) for _ in range(400)) for i in range(3000)}
    docs = spark.createDataFrame([*texts.items(), (ids[0], "again"), (None, "none")], "doc_id long, text string").repartition(4).localCheckpoint()
    rows = [(i, n % 2) for n, i in enumerate(ids[::10])] + [(ids[0], 1), (ids[0], 1), (ids[5], None), (ids[6], 2), (None, 1), (5000, 1), (next(i for i in range(3000) if fold(i, 5) == 0), 1)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    want = sorted([(texts[i], n % 2) for n, i in enumerate(ids[::10])] + [(texts[ids[0]], 1), ("again", 0), ("again", 1)])
    size = sum(len(t.encode()) for t in texts.values())

    def written():
        sc = spark.sparkContext._jsc.sc()
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorList(False).head().totalShuffleWrite()

    moved = []
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for most in (usual, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        try:
            before = written()
            got = toxicity.labelled_texts(spark, docs, labels).collect()
            moved.append(written() - before)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
        assert sorted((r["text"], r["y"]) for r in got) == want
    assert max(moved) < 0.3 * size and max(moved) < 1.2 * min(moved)
