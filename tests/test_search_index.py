"""The trigram index against searches of the whole sheet."""

import random
import re

import pytest

from kpiloom.functions.search import search_any, search_col
from kpiloom.operators.search_index import build_index, required

PATTERNS = ["building", "BUILD", "customer#0000000[1-3]", "building|customer#0000000[1-3]", "a", "ab", "b.ild", "bui(ld|x)ing", "buildings?", "build+ing", "bu{0,1}ilding",
            "build{2}ing", "^cust", r"r#0+1\d", r"1\.5", "nothing like this", ".*", "café", "CAFÉ", "(?i)build", "x|", "a*bc", "Kelvin", "in g", "[]x]abc", "", " ", None]


def test_derived_trigrams_are_in_every_match():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdAB.#é ") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    pieces = ["a", "b", "cd", "abc", "bcda", ".", "a?", "b*", "c+", "[ab]", "(ab|c)", r"\.", "|", "^", "d{1,2}", "d{0}", r"\w", "#a"]
    tried = 0
    for _ in range(1500):
        p = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 5)))
        try:
            rx = re.compile(p, re.I | re.A)
        except re.error:
            continue
        needs = required(p)
        if needs is None:
            continue
        tried += 1
        for t in texts:
            if rx.search(t):
                low = t.lower()
                assert any(all(g in low for g in n) for n in needs), (p, t, needs)
    assert tried > 100


def test_required():
    assert required("abcd") == [{"abc", "bcd"}] and required("ABC|xyz") == [{"abc"}, {"xyz"}] and required("abc|xy") is None
    assert required("ab?cde") == [{"cde"}] and required(r"a\.b") == [{"a.b"}] and required("(abc)") is None and required("Ab.", literal=True) == [{"ab."}]


@pytest.fixture(scope="module")
def sheet(spark):
    rng = random.Random(3)
    words = ["BUILDING", "building", "Café", "CAFÉ", "Kelvin K", "Customer#00000001", "x.y", None, "", "abc", "bc"]
    rows = [(i, rng.choice(words), round(rng.uniform(0, 9), 1), f"in g {i}" if i % 50 == 0 else None) for i in range(600)]
    return spark.createDataFrame(rows, "id long, name string, v double, note string").repartition(3).cache()


def test_same_rows_for_every_pattern(sheet, tmp_path):
    index = build_index(sheet, str(tmp_path / "i"), block_rows=32)
    key = lambda df: sorted(map(str, df.collect()))
    for p in PATTERNS:
        assert key(index.search(p)) == key(search_any(sheet, p)), p
        assert key(index.search(p, "name")) == key(search_col(sheet, "name", p)), p
        assert key(index.search(p, literal=True)) == key(search_any(sheet, p, True)), p


def test_blocks_read(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "concat('person ', id) AS name").coalesce(1)
    index = build_index(df, str(tmp_path / "i"), block_rows=64)
    assert index.blocks_read("person 999") == (1, 16) and index.search("person 999").count() == 1
    assert index.blocks_read("n 9") == (4, 16)          # 9, 90 to 99, and 900 to 999 across two blocks
    assert index.blocks_read(".*")[0] == 16 and index.blocks_read("zzz") == (0, 16)


def test_empty_sheet(spark, tmp_path):
    index = build_index(spark.range(0).selectExpr("id", "'a' AS name"), str(tmp_path / "i"))
    assert index.search("abc").collect() == [] and index.search("a").collect() == []
