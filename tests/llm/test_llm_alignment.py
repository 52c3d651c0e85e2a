"""Token alignment against overlaps counted pair by pair."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kpiloom.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return a, sentencepiece.SentencePieceProcessor(model_file=B), alignment.load(A, B)


def spans(ids, table):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(table[i]), i))
        at += len(table[i])
    return out


def plain_links(encoders, text):
    """(n_a, n_b, groups, links as id pairs), or None where there are no tokens."""
    a, b, pair = encoders
    ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
    if not text or any(b"".join(t[i] for i in ids) != b" " + text.encode() for ids, t in ((ids_a, pair.bytes_a), (ids_b, pair.bytes_b))):
        return None
    sa, sb = spans(ids_a, pair.bytes_a), spans(ids_b, pair.bytes_b)
    links = [(i, j) for lo, hi, i in sa for from_, to, j in sb if lo < to and from_ < hi]
    cuts = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
    groups = [([i for lo, hi, i in sa if before < hi <= cut], [j for lo, hi, j in sb if before < hi <= cut]) for before, cut in zip([0, *cuts], cuts)]
    return len(ids_a), len(ids_b), groups, links


def plain(encoders, rows):
    all_ = [(k, plain_links(encoders, t)) for k, t in rows]
    count = Counter(p for _, x in all_ if x for p in set(x[3]))
    most = {}
    for (i, _), n in count.items():
        most[i] = max(most.get(i, 0), n)
    out = []
    for k, x in all_:
        if x is None:
            out.append((k, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = x
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((k, n_a, n_b, len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(said.encode()).hexdigest()))
    return Counter(out)


def aligned(df, **more):
    return Counter(tuple(r) for r in alignment.align_tokens(df, A, B, **more).collect())


def test_query_equals_overlaps(worker_code, encoders):
    df = worker_code.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 3000")
    want = plain(encoders, [(r.doc_id, r.text) for r in df.collect()])
    assert aligned(df) == want
    assert aligned(df, head=300) == want    # most pairs by the join
    assert aligned(df, head=0) == want


def test_odd_rows(odd_docs, encoders):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    short = [(k, t) for k, t in rows if len(t or "") < 6000]
    df = odd_docs.where("text is null or length(text) < 6000")
    assert aligned(df) == plain(encoders, short)
    assert aligned(odd_docs.limit(0)) == Counter()
    extra = odd_docs.sparkSession.createDataFrame(
        [(1, "<s> </s> <unk> <0x41> <|endoftext|>"), (2, "a▁b"), (3, "ﬁ İ é \U0001f600‍"), (4, "  two  blanks "), (4, "\n\r\t\x0b")], "doc_id long, text string")
    assert aligned(extra) == plain(encoders, [(r.doc_id, r.text) for r in extra.collect()])


def test_stretches_of_long_texts_change_nothing(encoders, monkeypatch):
    pair, rng = encoders[2], random.Random(4)
    texts = ["".join(rng.choice("abcdefgh éñ\n日") for _ in range(rng.choice([1, 7, 90, 4000]))) for _ in range(30)] + ["x" * 3000, "\n" * 2000]
    docs = [x for x in map(pair.encode, texts) if x]
    whole = alignment.align(pair, docs)
    for stretch in (1, 5, 40):
        monkeypatch.setattr(alignment, "STRETCH", stretch)
        got = alignment.align(pair, docs)
        assert got[1] == whole[1] and all((got[0][c] == whole[0][c]).all() for c in whole[0])
        assert all((x == y).all() for x, y in zip(got[2:], whole[2:]))
    one = [alignment.align(pair, [d]) for d in docs]
    assert [x[1][0] for x in one] == whole[1]
    assert np.concatenate([x[3] for x in one]).tolist() == whole[3].tolist()
