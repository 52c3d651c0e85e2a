"""Language-model scores: the word model and the attention model against plain versions, gradients against differences."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from kpiloom.llm import attention, lm
from kpiloom.llm.queries import QUERIES, tokenizer


def plain_base(rows):
    """(doc_id, text) -> Counter of (doc_id, held_out, n_tokens, n_known, train_tokens, base rounded)."""
    cut = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in cut]
    c = Counter(w for (i, ws), h in zip(cut, held) if i is not None and not h for w in ws)
    total = sum(c.values())
    below = total + 0.1 * (len(c) + 1)
    return Counter((i, h, len(ws), sum(c[w] > 0 for w in ws), total, round(sum(math.log10((c[w] + 0.1) / below) for w in ws), 6)) for (i, ws), h in zip(cut, held))


def base_of(out):
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)


@pytest.fixture(scope="module")
def docs(worker_code):
    return worker_code.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_query_learns_and_scores_every_row(docs, worker_code):
    out = QUERIES["op12_lm_scores"][0](worker_code, "/root/testdata/sf0.01").collect()
    assert base_of(out) == plain_base([(r.doc_id, r.text) for r in docs.collect()])
    kept = [r for r in out if r.held_out]
    assert kept and all(r.score < 0 and math.isfinite(r.score) for r in out)
    # no text of those it is scored on was learned from: still better than a symbol's plain share
    names = lm.library.load(tokenizer())
    ids = {r.doc_id: names.plain_ids(lm.lowered(r.text or "").decode()) for r in docs.collect()}
    counts = np.bincount(np.concatenate([ids[r.doc_id] for r in out if not r.held_out]), minlength=50257) + 0.1
    plain = sum(np.log10(counts[ids[r.doc_id]] / counts.sum()).sum() for r in kept)
    assert sum(r.score for r in kept) > 0.9 * plain


def test_odd_rows_and_any_head(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    outs = [lm.score_texts(odd_docs, tokenizer(), head_words=n).collect() for n in (lm.HEAD_WORDS, 5, 0)]
    for out in outs:
        assert base_of(out) == plain_base(rows) and all(r.score < 0 for r in out)
    assert lm.score_texts(odd_docs.limit(0), tokenizer()).collect() == []


def symbols():
    counts = np.array([5.0, 1, -1, 4, 9, 2, 7, 3, -1])
    return attention.initial(counts, 3, dim=4), 3


def plain_text_score(p, t, width):
    """One position at a time, as the docstring says."""
    row, total = [attention.START, *t], 0.0
    soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    for i, nxt in enumerate([*t, attention.START]):
        lo = max(0, (i // attention.BLOCK - 1) * attention.BLOCK)
        e = p["e"][row].astype(float)
        q = e[i] @ p["wq"] / np.sqrt(e.shape[1])
        a = soft(np.array([q @ (e[j] @ p["wk"]) + p["near"][i - j] for j in range(lo, i + 1)]))
        h = e[i] + sum(w * (e[j] @ p["wv"]) for w, j in zip(a, range(lo, i + 1))) @ p["wo"]
        k, m = divmod(nxt, width)
        total += math.log(soft(h @ p["c"] + p["cb"])[k]) + math.log(soft(p["u"][k] @ h + p["ub"][k])[m])
    return total


def test_scores_equal_a_plain_loop_and_sum_to_one():
    p, width = symbols()
    rng = np.random.default_rng(2)
    for k in p:
        if not k.startswith("g_"):
            p[k] += rng.normal(0, 0.4, p[k].shape).astype(np.float32)
    p["ub"][0, 2] = p["ub"][2, 2] = attention.NEVER
    texts = [rng.choice([1, 3, 4, 5, 6, 7], n).astype(np.int32) for n in (0, 1, 15, 16, 17, 31, 32, 70, 5)]
    want = [plain_text_score(p, t.tolist(), width) for t in texts]
    for blocks in (1, 3, 100):
        assert attention.text_scores(p, texts, width, blocks) == pytest.approx(want, rel=1e-4)
    # the probabilities of all next symbols add up to one
    nexts = [0, 1, 3, 4, 5, 6, 7]
    h = attention.attend(p, *attention.blocks_of([texts[4]])[::2][:1], np.array([True, False]), None)["h"][3]
    probs = [math.exp(attention.log_probs(p, h[None], np.array([s]), width)[0][0]) for s in nexts]
    assert sum(probs) == pytest.approx(1, rel=1e-4)


def test_gradients_equal_differences(monkeypatch):
    p, width = symbols()
    p = {k: v.astype(np.float64) for k, v in p.items()}
    rng = np.random.default_rng(3)
    for k in list(p):
        if not k.startswith("g_") and k != "ub":
            p[k] += rng.normal(0, 0.5, p[k].shape)
    texts = [rng.choice([1, 3, 4, 5, 6, 7], n).astype(np.int32) for n in (40, 3, 20)]
    x, y, begins, _ = attention.blocks_of(texts)
    loss = lambda q: -attention.log_probs(q, attention.attend(q, x, begins, None)["h"], y.ravel(), width)[0].sum() / (y >= 0).sum()
    grads = {}

    def keep(state, name, g, at=None, rate=0):
        grads[name] = np.zeros_like(state[name])
        grads[name][slice(None) if at is None else at] = g

    monkeypatch.setattr(attention, "_down", keep)
    attention.train_step(p, x, y, begins, None, width)
    for name in ("e", "wq", "wk", "wv", "wo", "near", "c", "cb", "u"):
        flat = p[name].reshape(-1)
        for i in rng.choice(flat.size, min(6, flat.size), replace=False):
            was, step = flat[i], 1e-3
            flat[i] = was + step
            up = loss(p)
            flat[i] = was - step
            down = loss(p)
            flat[i] = was
            assert grads[name].reshape(-1)[i] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=2e-5), name


def test_extreme_logits_stay_finite():
    p, width = symbols()
    p["e"] *= 1000
    got = attention.text_scores(p, [np.array([3, 4, 5, 6] * 20, np.int32)], width, 4)
    assert np.isfinite(got).all()
    p["cb"][:] = [0, -500, -500]
    assert np.isfinite(attention.text_scores(p, [np.array([3, 4], np.int32)], width, 4)).all()
