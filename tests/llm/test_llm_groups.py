"""Links and groups (SimHash, embeddings, lines), url templates and the pipeline against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from kpiloom.llm import common, components, embeddings, lines, simhash, url_templates
from kpiloom.llm.queries import URL_RULES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(worker_code):
    return worker_code.read.parquet(f"{SF}/documents.parquet")


def groups(ids, linked):
    """id -> smallest id reachable."""
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components(worker_code):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    links = chain + [(1, x) for x in range(2, 40)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(50)] + [(5, 5), (None, 3)]
    df = worker_code.createDataFrame(links + links[:5], "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == groups({x for p in real for x in p}, real)
    assert components.components(df.limit(0)).count() == 0


def plain_fingerprint(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, odd_docs):
    for df in (docs, odd_docs.where("doc_id is not null")):
        rows = df.collect()
        prints = {r.doc_id: plain_fingerprint(r.text or "") for r in rows}
        ids = sorted(prints)
        want = groups(ids, [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
        got = simhash.simhash_groups(df).collect()
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == Counter((r.doc_id, f"{prints[r.doc_id]:016x}", want[r.doc_id]) for r in rows)
        kept = simhash.keep_first(df)
        assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(want.values())
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_keys_of_prints_are_not_broadcast(worker_code):
    """Few prints are a small table; their keys, 66 to a print, need not be."""
    prints = worker_code.createDataFrame([(i << 40, i) for i in range(50)], "fp long, rep long")
    assert "Broadcast" not in simhash.near_pairs(prints)._jdf.queryExecution().executedPlan().toString()


def test_pipeline_broadcasts_no_prints(worker_code, docs, monkeypatch):
    """Neither their keys nor the rows of all documents, which are far smaller in their files."""
    import corpus_pipeline
    plans = []

    def seen(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return components.components(links)

    monkeypatch.setattr(simhash, "components", seen)
    kept = corpus_pipeline.simhash_near_dedup(worker_code, docs, SF)
    assert len(plans) == 1 and "Broadcast" not in plans[0]
    assert not re.search(r"BroadcastHashJoin \[fp#", kept._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_pairs_within_bits(worker_code, bits):
    rng, prints = random.Random(bits), set()
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(8):
            f = base
            for _ in range(rng.randint(0, 4)):
                f ^= 1 << rng.randrange(64)
            prints.add(f)
    prints |= {0, (1 << 64) - 1, 1 << 63, 1 << 31, 1 << 32}
    fs = sorted(prints)
    df = worker_code.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fs)], "fp long, rep long")
    got = Counter((min(r.a, r.b), max(r.a, r.b)) for r in simhash.near_pairs(df, bits).collect())
    assert set(got) == {(j, i) for i in range(len(fs)) for j in range(i) if (fs[i] ^ fs[j]).bit_count() <= bits}


def vector_rows():
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.normal(size=24)
        for _ in range(15):
            rows.append((centre + rng.normal(size=24) * rng.choice([0.05, 0.35, 0.5])).astype(np.float32).tolist())
    rows += [rows[0], rows[0], [2 * x for x in rows[1]], [0.0] * 24, None, [], [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23,
             rows[0][:10], rows[0][:10], [0.0] * 23 + [1e-30], [1e30] * 24, [0.0] * 23 + [-0.0]]
    return [(i, v, "lab" if i % 2 else None, i) for i, v in enumerate(rows)]


def plain_links(vecs, t):
    def fine(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    good = {i: np.array(v, float) for i, v in vecs if fine(v)}
    good = {i: v / np.abs(v).max() for i, v in good.items()}
    ids = sorted(good)
    return [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if len(good[a]) == len(good[b])
            and good[a] @ good[b] / (np.linalg.norm(good[a]) * np.linalg.norm(good[b])) >= t]


@pytest.mark.parametrize("block", [16, 8192])
def test_embeddings(worker_code, block):
    rows = vector_rows()
    df = worker_code.createDataFrame(rows, "vec_id long, embedding array<float>, label string, n long")
    links = plain_links([(i, v) for i, v, _, _ in rows], 0.9)
    n, comp = Counter(x for p in links for x in p), groups([r[0] for r in rows], links)
    got = embeddings.near_vectors(df, block_rows=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == sorted((i, n[i], comp[i], comp[i] == i) for i in comp)
    assert embeddings.near_vectors(df.limit(0)).count() == 0
    assert embeddings.near_vectors(df.where("vec_id in (183, 184)")).where("kept and n_links = 0").count() == 2


def test_embeddings_on_the_table(worker_code):
    df = worker_code.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    links = plain_links(rows, 0.9)
    n, comp = Counter(x for p in links for x in p), groups([r[0] for r in rows], links)
    assert sorted(map(tuple, embeddings.near_vectors(df).collect())) == sorted((i, n[i], comp[i], comp[i] == i) for i in comp)


def plain_removed(rows, t=0.8, least=3):
    """(doc, line) to remove: every pair of lines is compared."""
    all_lines = []
    for i, text in rows:
        for no, line in enumerate((text or "").split("\n")):
            words = line.encode().lower().split()
            if len(words) >= least:
                all_lines.append((i, no, frozenset(words)))
    all_lines.sort(key=lambda x: x[:2])
    by_word, gone = {}, set()
    for k, (i, no, s) in enumerate(all_lines):
        near = {j for w in s for j in by_word.get(w, ())}
        if any(len(s & all_lines[j][2]) >= t * len(s | all_lines[j][2]) - 1e-9 and all_lines[j][:2] != (i, no) for j in near):
            gone.add((i, no))
        for w in s:
            by_word.setdefault(w, []).append(k)
    return gone


def near_lines_fixture():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choices(words, k=rng.randint(1, 14))
            text.append(" ".join(line))
            if rng.random() < 0.6:
                near = [*line]
                near[rng.randrange(len(near))] = rng.choice(words)
                text.append(" ".join(near).upper() if rng.random() < 0.3 else " ".join(near))
        out.append((i, "\n".join(text)))
    return out


def test_line_dedup(worker_code, docs, odd_docs):
    made = worker_code.createDataFrame(near_lines_fixture(), "doc_id long, text string")
    for df in (made, docs, odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        want = plain_removed(rows)
        got = lines.dedup_lines(df)
        assert got.columns == [*df.columns, "n_exact", "n_near"]
        texts = {r.doc_id: (r.text, r.n_exact + r.n_near) for r in got.collect()}
        for i, t in rows:
            left = None if t is None else "\n".join(x for no, x in enumerate(t.split("\n")) if (i, no) not in want)
            assert texts[i] == (left, sum(d == i for d, _ in want))
    assert lines.dedup_lines(odd_docs).count() == odd_docs.count()
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_short_lines_are_deduplicated(worker_code, docs):
    """The query and the pipeline's stage take lines from one word on."""
    import corpus_pipeline
    from kpiloom.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_removed(rows, least=1)
    assert want > plain_removed(rows)
    left = {i: None if t is None else "\n".join(x for no, x in enumerate(t.split("\n")) if (i, no) not in want) for i, t in rows}
    assert {r.doc_id: r.text for r in QUERIES["op6_line_dedup"][0](worker_code, SF).collect()} == left
    short = worker_code.createDataFrame([(1, "Yes.\nOf course\nyes."), (2, "YES.\ncourse of\nno"), (3, "no no\n\nyes. no")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in corpus_pipeline.line_dedup(worker_code, short, SF).collect()} == {1: "Yes.\nOf course", 2: "no", 3: "\nyes. no"}


def test_rows_that_share_an_id_lose_only_their_own_lines(worker_code):
    """Null and repeated ids: a duplicate in line k of one row leaves line k of the others alone, for equal and near lines."""
    said, near = "the same nine words are said here once more", "the same nine words are said here once again more"
    rows = [(1, f"{said}\nfirst text of all")]
    rows += [(None, f"{said}\nnull row number {w} has {w} alone") for w in "ab"] + [(None, f"only {w} here, never elsewhere {w}{w}\nsome tail {w}") for w in "cd"]
    rows += [(7, f"{near}\nseven one ends"), (7, "seven begins in quite another way\nseven two goes on"), (7, None), (None, None)]
    rows += [(9, "nine is repeated as it is"), (9, "nine is repeated as it is")]
    df = worker_code.createDataFrame(rows, "doc_id long, text string")
    want = Counter((i, t if t is None or i == 1 else "\n".join(x for x in t.split("\n") if x not in (said, near))) for i, t in rows)
    for part in (df, df.where("doc_id is null or doc_id = 1")):
        got = lines.dedup_lines(part, least_words=1).collect()
        assert Counter((r.doc_id, r.text) for r in got) == Counter({k: n for k, n in want.items() if part is df or k[0] in (None, 1)})
        assert sorted(r.n_exact + r.n_near for r in got) == [0] * (len(got) - (3 if part is df else 2)) + [1] * (3 if part is df else 2)


def test_line_candidates_come_in_rounds(worker_code):
    """The rounds together give the same candidates as one round without a limit, each once per line and word."""
    texts = lines._texts(worker_code.createDataFrame(near_lines_fixture(), "doc_id long, text string"), "doc_id", "text")
    sets = lines.line_sets(texts, lines.word_counts(texts), 0.4, 3).dropDuplicates(["d0", "d1"])
    index = lines._index(sets).cache()
    every = {tuple(r) for r in lines.candidates(index, 0.4, 0, 10**6).collect()}
    some, skip, take = set(), 0, 1
    while now := {tuple(r) for r in lines.candidates(index, 0.4, skip, take, sets.select("doc", "line")).collect()}:
        some |= now
        skip, take = skip + take, 2 * take
    assert some == every and skip > 1


def test_url_rules(worker_code):
    urls = ["http://a.org/x", "HTTP://A.ORG/x", "http://org/x", "http://xorg/x", "http://example.org/es/1", "http://www.EXAMPLE.org/es/", "http://example.org/es",
            "http://example.org/en/17?q#f", "http://example.org/en/2", "http://b.com/fr/1", "http://b.com/de/1#x", "http://b.com/FR/1", "http://b.com", "no scheme", None, "",
            "x://y://z.org/q", "http://b.net?x=/de/", "http://é.COM/de/é\n/x"]
    df = worker_code.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] + [(3, urls[3], None, None)], "page_id long, url string, host string, rule string")
    got = url_templates.judge(df, URL_RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
        fit = [(len(t), t, v) for v, t in URL_RULES for h, _, p in [t.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        _, rule, verdict = max(fit, default=(0, None, None))
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert url_templates.judge(df.limit(0), URL_RULES).count() == 0


def plain_shape(s):
    if re.fullmatch("[0-9]+", s):
        return "{n}"
    if re.fullmatch("[0-9]{4}-[0-9]{2}-[0-9]{2}", s):
        return "{d}"
    if re.fullmatch("(?=.*[0-9])[0-9a-fA-F-]{8,}", s):
        return "{x}"
    return re.sub("[0-9]+", "{n}", s)


def plain_templates(rows):
    """rows: (host, path, said or None) -> template and purity of each, level by level."""
    def form(s):
        return 0 if s == "" else 1 if s in ("{n}", "{d}", "{x}") else 3 if "{" in s else 2
    items = [{"host": host, "said": said, "s": [*map(plain_shape, re.sub("^/", "", path).split("/")), ""], "t": []} for host, path, said in rows]
    level, live = 0, items
    while live:
        def stat(xs):
            known = [x["said"] for x in xs if x["said"]]
            after = [form(x["s"][level + 1] if level + 1 < len(x["s"]) else "") for x in xs]
            return len(xs), len(known), known.count("block"), max(range(4), key=lambda i: (after.count(i), -i))
        by_parent, by_child = {}, {}
        for x in live:
            p = (x["host"], *x["t"])
            by_parent.setdefault(p, []).append(x)
            by_child.setdefault((*p, x["s"][level]), []).append(x)
        named, few = {}, set()
        for child, xs in by_child.items():
            s = child[-1]
            n, known, blocked, main = stat(xs)
            pn, pk, pb, pmain = stat(by_parent[child[:-1]])
            alike = main == pmain
            if alike and known and pb not in (0, pk):
                alike = abs(blocked / known - pb / pk) / np.sqrt(pb / pk * (1 - pb / pk) / known) < 2
            named[child] = "" if s == "" else "**" if pn < 3 else s if n == pn and "{" not in s else "*" if n < 3 or n < 0.02 * pn or alike else s
            if s != "" and pn < 3:
                few.add(child)
        for x in live:
            x["at"] = (x["host"], *x["t"], x["s"][level])
        for x in live:
            x["t"].append(named[x["at"]])
        level += 1
        live = [x for x in live if len(x["s"]) > level and x["at"] not in few]
    known = [x["said"] for x in items if x["said"]]
    rate = known.count("block") / len(known) if known else 0
    out, by = [], {}
    for x in items:
        x["template"] = re.sub("/+$", "", "/".join(["", *x["t"]]))
        by.setdefault((x["host"], x["template"]), []).append(x["said"])
    for x in items:
        own = by[x["host"], x["template"]]
        k = [s for s in own if s]
        h = [y["said"] for y in items if y["host"] == x["host"] and y["said"]]
        near = (h.count("block") + 10 * rate) / (len(h) + 10)
        out.append((x["template"], (k.count("block") + 10 * near) / (len(k) + 10)))
    return out


def test_url_templates_equal_a_plain_version(worker_code):
    pages = worker_code.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rng = random.Random(8)
    made = [(1000 + i, f"http://shop{i % 2}.com/{rng.choice(['de', 'de', 'fr', 'en', 'x' + str(i)])}/{rng.choice(['item', 'cat', str(i)])}/{i}"
             + rng.choice(["", "/a/b", ".html"]), None) for i in range(600)]
    got = url_templates.judge(pages.unionByName(worker_code.createDataFrame(made, "page_id long, url string, html string")), URL_RULES).collect()
    want = plain_templates([(r.host, r.path, r.verdict if r.rule else None) for r in got])
    for r, (template, purity) in zip(got, want):
        assert r.template == template and r.purity == pytest.approx(purity)
        assert r.rule or r.verdict == ("block" if purity >= 0.8 else "allow")
    assert any(r.verdict == "block" and not r.rule for r in got) or all(p < 0.8 for (_, p), r in zip(want, got) if not r.rule)


def test_pure_template_is_rejected(worker_code):
    """Pages under one template that the rules nearly always block; the few that no rule fits follow."""
    rows = [(i, f"http://s.com/{i}/x") for i in range(60)]
    got = url_templates.judge(worker_code.createDataFrame(rows, "page_id long, url string"), [("block", f"s.com/{i}") for i in range(1, 10)])
    assert {r.verdict for r in got.collect()} == {"block"}
    clean = url_templates.judge(worker_code.createDataFrame(rows, "page_id long, url string"), [("allow", f"s.com/{i}") for i in range(1, 10)])
    assert {r.verdict for r in clean.collect()} == {"allow"}


def test_branches_part_at_any_depth(worker_code):
    """Pages that differ in their fourth and sixth segment only; the rules label two of three."""
    for before in ("a/b/c", "a/b/c/d/e"):
        rows = [(i, f"http://s.com/{before}/{'bad' if i % 2 else 'ok'}/{i}") for i in range(240)] + [(999, "http://s.com/" + "x/" * 300)]
        rules = [("block" if i % 2 else "allow", f"s.com/{before}/{'bad' if i % 2 else 'ok'}/{i}") for i in range(240) if i % 3]
        got = url_templates.judge(worker_code.createDataFrame(rows, "page_id long, url string"), rules).collect()
        open_pages = [r for r in got if r.rule is None and r.page_id != 999]
        assert len(open_pages) > 30 and all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in open_pages)
        depth = before.count("/") + 1
        assert {r.template for r in open_pages} == {"/*" * depth + "/bad/*", "/*" * depth + "/ok/*"}  # the odd page makes their heads variables
        assert [r.template for r in got if r.page_id == 999] == ["/*" * (depth + 1) + "/**"]


def test_pipeline_stages_keep_the_columns(worker_code):
    import corpus_pipeline
    docs = worker_code.read.parquet(f"{SF}/documents.parquet")
    part = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        part = stage(worker_code, part, SF)
        assert part.columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(worker_code, docs.limit(0), SF).count() == 0


def test_pipeline_takes_short_lines(worker_code):
    """The documents and token counts of the pipeline against brute force with lines from one word on."""
    import corpus_pipeline
    from kpiloom.llm import bpe, pii, quality
    from kpiloom.llm.queries import tokenizer
    docs = worker_code.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in quality.keep(docs).collect()}
    gone = plain_removed(sorted(rows.items()), least=1)
    rows = {i: "\n".join(x for no, x in enumerate(t.split("\n")) if (i, no) not in gone) for i, t in rows.items()}
    prints = {i: plain_fingerprint(t) for i, t in rows.items()}
    ids = sorted(rows)
    comp = groups(ids, [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    coder = bpe.load(tokenizer())
    want = {i: coder.count(pii.masked(t)) + 1 for i, t in rows.items() if comp[i] == i}
    assert {r.doc_id: r.doc_tokens for r in corpus_pipeline.run(worker_code, SF).collect()} == want


def test_pipeline_stages_on_odd_rows(worker_code, odd_docs):
    import corpus_pipeline
    part = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(worker_code, odd_docs, SF)
        assert out.count() <= 10 * odd_docs.count(), name
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == part.columns


def test_rows_that_share_an_id_go_by_their_own_text(worker_code):
    texts = {"T1": "one text of a handful of words", "T2": "quite another sentence about other things"}
    df = worker_code.createDataFrame([(i, texts[t], 7) for i, t in ((5, "T1"), (9, "T1"), (3, "T2"), (5, "T2"))], "doc_id long, text string, g0 int")
    assert sorted((r.doc_id, r.text) for r in simhash.keep_first(df).collect()) == [(3, texts["T2"]), (5, texts["T1"])]


def test_vectors_that_share_an_id_have_their_own_links(worker_code):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (7, [0.05, 1.0]), (8, [1.0, 0.0]), (9, [-1.0, -1.0])]
    got = embeddings.near_vectors(worker_code.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [
        (5, 1, 5, True), (5, 1, 5, True), (7, 1, 5, False), (8, 1, 5, False), (9, 0, 9, True)]


def test_line_dedup_with_clashing_names(worker_code):
    rows = [(1, "same line of words here\nown text one", 5, 6, 77, 78, "a"), (2, "same line of words here\nown text two", 5, 6, 77, 78, "b")]
    df = worker_code.createDataFrame(rows, "doc_id long, text string, n_exact int, _gone int, _doc int, own_row int, `gone` string")
    got = lines.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "_gone", "_doc", "own_row", "gone", "n_exact", "n_near"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, rows[0][1], 6, 77, 78, "a", 0, 0), (2, "own text two", 6, 77, 78, "b", 1, 0)]


def test_word_hashes_follow_words_and_lines(monkeypatch):
    """Equal words have equal hashes wherever they stand, whatever piece they fall into; blanks are those of bytes.split()."""
    rng = random.Random(4)
    for piece in (1 << 16, 7):
        monkeypatch.setattr(lines, "PIECE", piece)
        for _ in range(200):
            data = bytes(rng.choice(b" \t\n\x0b\x0c\rab\x00\x1c\x85\xc3\xa9") for _ in range(rng.randrange(60)))
            got = list(zip(*(x.tolist() for x in lines.word_hashes(data))))
            assert got == [(int(lines.word_hashes(w)[0][0]), no) for no, line in enumerate(data.split(b"\n")) for w in line.split()]
    long = b"x" * (lines.LONG_WORD + 1)
    assert len({int(lines.word_hashes(w)[0][0]) for w in (long, long + b"x", long[:-1], b"x", b"ab", b"ba")}) == 6


def test_later_rounds_take_only_their_lines(worker_code):
    texts = lines._texts(worker_code.createDataFrame([(i, f"a b c{i}\nd e f{i}") for i in range(4)], "doc_id long, text string"), "doc_id", "text")
    pairs = lambda *p: worker_code.createDataFrame([(a, 0, 0, b, 0, 0) for a, b in p], "doc long, row long, line int, e_doc long, e_row long, e_line int")
    first, known = lines.line_words(pairs((1, 0), (2, 1)), texts)
    assert first.count() == known.count() == 3
    own, known = lines.line_words(pairs((3, 2)), texts, known)
    assert {(r.doc, *sorted(r.s)) for r in own.collect()} == {(2, "a", "b", "c2"), (3, "a", "b", "c3")} and known.count() == 4
    own, known = lines.line_words(pairs((3, 0)), texts, known)
    assert {r.doc for r in own.collect()} == {0, 3} and known.count() == 4


def test_index_rows_gather_over_small_batches():
    """Few meetings however small the batches, each word whole in one of them, and nothing lost or reordered."""
    rng = np.random.default_rng(4)
    word = np.sort(np.concatenate([rng.integers(0, 400, 3000), np.full(900, 77)]))
    rows = pa.RecordBatch.from_pydict({"word": word, "doc": np.arange(len(word))})
    for size in (1, 7, 100, 5000):
        batches = [rows.slice(i, size) for i in range(0, len(word), size)] + [rows.slice(0, 0)]
        got = list(lines._whole_words(iter(batches), 500))
        assert np.concatenate([x["doc"] for x in got]).tolist() == list(range(len(word)))
        assert all(len(x["doc"]) > 400 for x in got[:-1]) and len(got) <= 8
        whole = [set(x["word"].tolist()) for x in got]
        assert sum(map(len, whole)) == len(set(word.tolist()))
    assert list(lines._whole_words(iter([rows.slice(0, 0)]), 500)) == []


@pytest.mark.parametrize("gathered", [1, 1 << 20])
def test_line_candidates_do_not_depend_on_batches(worker_code, monkeypatch, gathered):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.sample("a b c d e f g h i j".split(), 8))) for i in range(120)]
    texts = lines._texts(worker_code.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    index = lines._index(lines.line_sets(texts, lines.word_counts(texts), 0.5, 1)).localCheckpoint()
    want = Counter(tuple(r) for r in lines._nearest(index, 0.5, 0, 4).collect())
    monkeypatch.setattr(lines, "GATHERED", gathered)
    before = worker_code.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    worker_code.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert Counter(tuple(r) for r in lines._nearest(index, 0.5, 0, 4).collect()) == want and want
    finally:
        worker_code.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("docs, rows", [((0, 50), (0, 1)), ((-5, 5), (0, 1)), ((0, 5), (-2, 2)), ((-(1 << 63), lines.LAST), (0, 1))])
def test_index_rows_of_a_word_are_ordered_by_line(docs, rows):
    """Whatever the ids: few, negative, told apart by row, or too far apart for one packed number."""
    rng = np.random.default_rng(7)
    n = 3000
    a = {"word": np.sort(rng.integers(-9, 9, n)), "doc": rng.integers(*docs, n), "row": rng.integers(*rows, n), "line": rng.integers(0, 90, n).astype(np.int32), "at": np.arange(n)}
    got = lines._by_line(a)
    want = sorted(zip(*(a[c].tolist() for c in ("word", "doc", "row", "line"))))
    assert list(zip(*(got[c].tolist() for c in ("word", "doc", "row", "line")))) == want
    assert sorted(got["at"].tolist()) == list(range(n)) and all((a[c][got["at"]] == got[c]).all() for c in a)
    assert lines._by_line({c: x[:1] for c, x in a.items()})["at"].tolist() == [0]


def test_index_rows_are_sorted_by_one_number(worker_code):
    """Spark sorts by the word alone; the lines of a word are put in order in the arrays, and in whatever order they come the candidates are the same."""
    rows = [(i, " ".join(random.Random(i).sample("a b c d e f g h i j".split(), 8))) for i in range(60)]
    texts = lines._texts(worker_code.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    index = lines._index(lines.line_sets(texts, lines.word_counts(texts), 0.5, 1)).localCheckpoint()
    near = lines._nearest(index, 0.5, 0, 4)
    sorts = re.findall(r"Sort \[[^\]]*\]", near._jdf.queryExecution().optimizedPlan().toString())
    assert len(sorts) == 1 and sorts[0].count("ASC") == 1
    back = lines._nearest(index.orderBy(F.desc("doc")), 0.5, 0, 4)
    assert Counter(tuple(r) for r in back.collect()) == Counter(tuple(r) for r in near.collect())


def test_later_rounds_write_few_files(worker_code):
    """The lines of a later round are few; they do not come in as many files as the lines read so far."""
    texts = lines._texts(worker_code.createDataFrame([(i, f"a b c{i}") for i in range(64)], "doc_id long, text string"), "doc_id", "text")
    pairs = worker_code.createDataFrame([(i, 0, 0, i - 1, 0, 0) for i in range(1, 64)], "doc long, row long, line int, e_doc long, e_row long, e_line int")
    _, known = lines.line_words(pairs, texts)
    for more in (pairs, pairs.unionByName(pairs.limit(1).withColumn("e_doc", F.lit(0).cast("long")))):
        own, _ = lines.line_words(more, texts, known.repartition(8).localCheckpoint())
        assert own.count() == 64 and len(own.inputFiles()) == 1


def test_sets_of_words_lower_only_a_to_z(worker_code):
    said = ["The THE the", " \tA\x0bB\x0c\r a ", "", "\u212a K k", "\u00c0B \u00e0b \u00c0b", "\u0130I i", "[Z] @Z {z}"]
    got = worker_code.createDataFrame([(i, x) for i, x in enumerate(said)], "i long, x string").select("i", lines._set_of(F.col("x")).alias("s")).collect()
    for r in got:
        assert r.s == [w.decode() for w in dict.fromkeys(said[r.i].encode().lower().split())]


def test_large_sides_are_merged_whatever_their_files(worker_code, docs, monkeypatch):
    """Line dedup and components: a million keys may be a file of a few hundred KB."""
    some, plans = docs.limit(60), []
    links = worker_code.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
    want = sorted(lines.removed_lines(some).collect()), sorted(components.components(links).collect())

    def seen(module):
        def keep(df, name, codec=None, real=module.stored):
            if name in ("open-lines", "line-candidates", "links"):
                plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
            return real(df, name, codec)
        monkeypatch.setattr(module, "stored", keep)

    seen(lines)
    seen(components)
    monkeypatch.setattr(common, "SENT", 0, raising=False)
    assert (sorted(lines.removed_lines(some).collect()), sorted(components.components(links).collect())) == want
    assert {n for n, p in plans} == {"open-lines", "line-candidates", "links"}
    assert [n for n, p in plans if "BroadcastHashJoin" in p] == []
