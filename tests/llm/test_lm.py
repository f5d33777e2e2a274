import random
import zlib
from collections import Counter

import numpy as np

from sitewise.llm import attention as A
from sitewise.llm import lm as L
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def corpus(n=250, seed=1):
    r = random.Random(seed)
    parts = ["tion", "ing", "ver", "al", "en", "or", "ist"]
    content = ["".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(60)]
    texts = [" ".join(r.choice(["the", "of", "and"]) + " " + (r.choice(content) if r.random() < 0.9 else "".join(r.choice(parts) for _ in range(4))) for _ in range(r.randrange(1, 60))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)]


def test_contract_columns(spark):
    rows = corpus() + [(900, None), (901, " \n"), (None, "The of"), (3, "The  OF\tand É"), (902, "of " * 30_000)]
    got = L.score_documents(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n", "2 as key", "3 as score"), sample_docs=200, head=5).collect()
    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update([*brute.words(t), None])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        w = [*brute.words(t), None]
        want[(i, held(i), len(w), sum(counts[x] > 0 for x in w), n, round(sum(np.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 4))] += 1
    assert Counter((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 4)) for x in got) == want
    assert all(np.isfinite(x.score) and x.score < 0 for x in got)
    better = [x.score > x.base_score for x in got if x.held_out and x.n_tokens > 20]
    assert np.mean(better) > 0.6


def test_other_tables(spark):
    assert L.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    only = next(i for i in range(1000) if held(i))
    one = L.score_documents(spark.createDataFrame([(only, "a b"), (only, None)], SCHEMA)).collect()
    assert sorted((x.n_tokens, x.n_known, x.train_tokens) for x in one) == [(1, 0, 0), (3, 0, 0)] and all(x.score < 0 for x in one)


def small_model():
    texts = [t for _, t in corpus(60)]
    path = L.default_path()
    counts = sum(np.bincount(L.text_ids(t, path), minlength=L.VOCABULARY) for t in texts)
    return L.fit(texts, counts.astype(float), path, 500, 1), path


def test_scores_equal_brute_force_over_windows():
    model, path = small_model()
    texts = [L.text_ids(t, path) for t in ("", "the version of", "of the tional " * 40, "é" * 100)]
    for ids, score in zip(texts, model.log10(texts), strict=True):
        total, before, seen, within = 0.0, model.inputs(ids), [], model.log10_within(ids)
        for at, skip in A.windows(len(ids)):
            stop = min(at + A.WINDOW, len(ids))
            h = model.attention.hidden(before[None, at:stop])[0][0]
            for place in range(at + skip, stop):
                z = (h[place - at] @ model.attention.p["out"] + model.attention.p["b"]).astype(float)
                p = np.exp(z - z.max())
                total += np.log10(p[model.class_of[ids[place]]] / p.sum()) + within[place]
                seen.append(place)
        assert seen == list(range(len(ids)))  # each place once
        assert abs(total - score) < 1e-3 * max(1, len(ids) / 10)


def test_probabilities_sum_to_one():
    model, _ = small_model()
    counts = np.random.default_rng(3).poisson(0.01, L.VOCABULARY)
    for logs in (model.within[0].astype(float), model.after(counts)):
        within = np.bincount(model.class_of, 10.0**logs, L.SINGLES + L.GROUPS)
        assert np.allclose(within[np.bincount(model.class_of, minlength=len(within)) > 0], 1, atol=6e-3)  # half precision


def test_pairs_are_counted_over_all_documents(spark):
    model, path = small_model()
    texts = [t for _, t in corpus(80, seed=9)]
    ids = [L.text_ids(t, path) for t in texts]
    encoded = spark.createDataFrame([(0, bytearray(i.astype(np.uint16).tobytes())) for i in ids], "round int, ids binary").repartition(3)
    got = L._paired(model, encoded)
    counts = np.zeros((L.PAIRED + L.GROUPS + 1, L.VOCABULARY))
    for i in ids:
        np.add.at(counts, (model.before(i), i), 1)
    for unit in range(len(counts)):
        assert np.allclose(got.within[unit].astype(float), model.after(counts[unit]), atol=5e-3)
    assert sum(got.log10([i])[0] for i in ids) > sum(model.log10([i])[0] for i in ids)


def test_ahead_of_word_counts_on_the_given_table(spark):
    """Held-out documents of the table: the model's log probability is above that of counted words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.score_documents(docs).where("held_out").collect()
    assert len(rows) > 50 and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_attention_is_causal_and_gradients_are_right():
    r = np.random.default_rng(1)
    model = A.Attention.new(20, 7, dim=6)
    units, classes = r.integers(0, 20, (3, A.WINDOW)), r.integers(0, 7, (3, A.WINDOW))
    other = units.copy()
    other[:, 20:] = r.integers(0, 20, (3, A.WINDOW - 20))
    assert np.allclose(model.hidden(units)[0][:, :20], model.hidden(other)[0][:, :20], atol=1e-5)
    model.p = {n: v.astype(np.float64) for n, v in model.p.items()}
    weight = (r.random((3, A.WINDOW)) > 0.3).astype(np.float64)
    _, g = model.gradients(units, classes, weight)
    for n, v in model.p.items():
        i = tuple(int(r.integers(0, s)) for s in v.shape)
        if n == "e":
            i = (int(units[0, 3]), 2)
        v[i] += 1e-4
        up = model.gradients(units, classes, weight)[0]
        v[i] -= 2e-4
        down = model.gradients(units, classes, weight)[0]
        v[i] += 1e-4
        assert abs((up - down) / 2e-4 - g[n][i]) < 1e-3 * max(1, abs(g[n][i]) * 10), n


def test_training_lowers_the_loss():
    r = np.random.default_rng(2)
    seq = np.cumsum(r.integers(1, 3, (300, A.WINDOW)), 1) % 11
    model = A.Attention.new(12, 11)
    before = np.concatenate([np.full((300, 1), 11), seq[:, :-1]], 1)
    start = model.gradients(before, seq, np.ones(seq.shape))[0]
    assert model.train(before, seq, np.ones(seq.shape, np.float32), epochs=12) < 0.45 * start


def test_attention_learns_from_documents_outside_the_sample(spark):
    """With no text sampled, only going through all documents can teach the order of words."""
    r = random.Random(7)
    cycle = [f"{a}{b}" for a in ("red", "old", "sea") for b in ("house", "stone", "river", "cloud")]
    texts = [" ".join(cycle[(s + k) % len(cycle)] for k in range(100)) for s in (r.randrange(len(cycle)) for _ in range(1500))]
    got = L.score_documents(spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4), sample_docs=0).where("held_out").collect()
    start = L.fit([], sum(np.bincount(L.text_ids(t, L.default_path()), minlength=L.VOCABULARY) for i, t in enumerate(texts) if not held(i)).astype(float), L.default_path())
    of_start = start.log10([L.text_ids(texts[x.doc_id], L.default_path()) for x in got])
    assert np.mean([x.score for x in got]) > 0.6 * np.mean(of_start)


def test_sample_takes_each_text_once(spark, monkeypatch):
    seen = []
    fit = L.fit
    monkeypatch.setattr(L, "fit", lambda texts, *a, **k: seen.extend(texts) or fit(texts, *a, **k))
    rows = [(i, f"copied text {i // 100}") for i in range(1000)]
    L.score_documents(spark.createDataFrame(rows, SCHEMA), sample_docs=5)
    assert len(seen) == len(set(seen)) == 5


def test_words_are_cut_into_ids_once_and_as_in_whole_texts(monkeypatch):
    path = L.default_path()
    encode, calls = L._vocabulary(path)[0].encode_ordinary, []
    r = random.Random(5)
    odd = "abZ é'stll1 9 \t\n\x0b\x1c\x1f\x85  　​中😀.,!?-'re\ud800 ½²"
    texts = [None, "", " \n", *("".join(r.choice(odd) for _ in range(r.randrange(14))) for _ in range(2000))]
    for text, ids in zip(texts, L._packed_ids(texts, path), strict=True):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        whole = encode(" " + b" ".join(words).decode("utf-8", "replace")) if words else []
        assert np.frombuffer(ids, np.uint16).tolist() == [*whole, L.END_ID], repr(text)

    class Counted:
        @staticmethod
        def encode_ordinary(text):
            calls.append(text)
            return encode(text)

    monkeypatch.setattr(L, "_vocabulary", lambda _: (Counted, {}))
    plain = [t for _, t in corpus(50, seed=11)]
    first = L._packed_ids(plain * 3, path)
    assert len(calls) <= 1 and L._packed_ids(plain, path) == first[:50] and len(calls) <= 1
    monkeypatch.setattr(L, "KNOWN_WORDS", 0)
    assert L._packed_ids(["unseenword of the", "of unseenword"], path) == L._packed_ids(["unseenword of the", "of unseenword"], path)
    assert b"unseenword" not in L._known(path)


def test_places_that_only_give_context_are_not_computed():
    r = np.random.default_rng(3)
    model = A.Attention.new(20, 7, dim=6)
    units = r.integers(0, 20, (3, A.WINDOW))
    got = model._states(units, model.products(), A.OVERLAP)[0]
    assert got.shape == (3 * (A.WINDOW - A.OVERLAP), 7) and np.allclose(got[:, -1], 1)
    assert np.allclose(got[:, :-1], model.hidden(units)[0][:, A.OVERLAP :].reshape(len(got), 6), atol=1e-5)


def test_step_changes_weights_in_place_by_adam():
    r = np.random.default_rng(4)
    model = A.Attention.new(20, 7, dim=6)
    units, classes, weight = r.integers(0, 20, (3, A.WINDOW)), r.integers(0, 7, (3, A.WINDOW)), np.ones((3, A.WINDOW), np.float32)
    want = {n: v.astype(np.float64) for n, v in model.p.items()}
    m, s = ({n: np.zeros_like(v) for n, v in want.items()} for _ in range(2))
    adam = A.Adam(model)
    held = dict(model.p)
    for k in range(1, 4):
        g = model.gradients(units, classes, weight)[1]
        adam.step(units, classes, weight, 1e-2)
        for n, d in g.items():
            m[n], s[n] = 0.9 * m[n] + 0.1 * d, 0.99 * s[n] + 0.01 * d * d
            want[n] -= 1e-2 * (m[n] / (1 - 0.9**k)) / (np.sqrt(s[n] / (1 - 0.99**k)) + 1e-8)
    for n, v in want.items():
        assert model.p[n] is held[n] and np.abs(model.p[n] - v).max() < 1e-3


def test_windows_of_a_long_text_come_in_parts(monkeypatch):
    model, path = small_model()
    ids = L.text_ids("of the version " * 100, path)
    whole = list(model.windows(ids))
    monkeypatch.setattr(L, "SHUFFLED", 3)
    parts = list(model.windows(ids))
    assert len(whole) == 1 and len(parts) > 2 and max(len(u) for u, _, _ in parts) == 3
    for one, many in zip(whole[0], zip(*parts, strict=True), strict=True):
        assert np.array_equal(one, np.concatenate(many))
    u, c, w = whole[0]
    assert np.array_equal(u.ravel()[: len(ids)], model.inputs(ids)) and np.array_equal(c.ravel()[: len(ids)], model.class_of[ids]) and w.sum() == len(ids)
