"""Terms and targets: one search for all, and the two readings of the target table against each other."""

import random
import re
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.functions import terms, text
from docloom.functions.targets import FAMILIES, SPELLINGS, TARGETS, TargetTable


def every(words, t):
    return sorted({i for i, w in enumerate(words) if w and w in t})


@pytest.mark.parametrize("native", [True, False])
def test_automaton_finds_what_a_scan_finds(native):
    r = random.Random(3)
    for _ in range(200):
        words = ["".join(r.choice("abé語") for _ in range(r.randint(0, 5))) for _ in range(r.randint(0, 12))]
        t = "".join(r.choice("abé語c") for _ in range(r.randint(0, 60)))
        found = terms.Automaton(words, native=native)
        first = {w: words.index(w) for w in words}
        want = sorted((m.start(), first[w]) for w in set(words) if w for m in re.finditer(f"(?={re.escape(w)})", t))
        assert sorted(found.matches(t)) == want
        assert found.present(t) == sorted({i for _, i in want})


def test_column_of_terms(spark):
    words = [f"w{i}x" for i in range(1000)] + ["x w"]
    r = random.Random(4)
    rows = [(i, " ".join(f"w{r.randint(0, 1200)}x" for _ in range(20))) for i in range(50)] + [(50, None), (51, "")]
    got = spark.createDataFrame(rows, "i int, t string").select("i", terms.present_terms(spark, F.col("t"), words).alias("n")).collect()
    assert {g.i: g.n for g in got} == {i: every(words, t or "") for i, t in rows}
    with pytest.raises(ValueError):
        terms.present_terms(spark, F.col("t"), ["a", "a"])


def test_terms_of_a_batch_are_never_python_objects_all_at_once():
    """10,000 texts of 4 KB with 50 terms each: strings and lists of numbers would take 40 MB and 8 MB."""
    words = [f"w{i:03d}x" for i in range(600)]
    rows = [" ".join(words[300 + (i * j) % 300] for j in range(50)) + "." * 3700 for i in range(1, 1001)]
    automaton, texts = terms.Automaton(words), pa.array([None, "", *rows * 10])
    tracemalloc.start()
    found = terms.present_in(automaton, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20
    assert found.slice(0, 302).to_pylist() == [every(words, t or "") for t in [None, "", *rows[:300]]]
    assert found.type == pa.list_(pa.int32()) and len(found) == len(texts) and terms.present_in(automaton, texts.slice(0, 0)).to_pylist() == []


def test_targets_by_rule(spark):
    r = random.Random(5)
    bits = [p + m for p, members in FAMILIES for m in members.split()] + list(SPELLINGS) + ["x", " ", "3A", "CYP", "1", "0", "ugt", "qt"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 4))) for _ in range(600)]

    def plain(t):
        up = t.upper().replace(" ", "")
        for prefix, members in FAMILIES:
            if m := re.search(f"{prefix}(?:{'|'.join(members.split())})", up):
                return m[0]
        return next((c for s, c in SPELLINGS.items() if s in up), None)

    assert [TARGETS.find(t) for t in texts] == [plain(t) for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", TARGETS.find_column(F.col("t"), F.lit("")).alias("c")).orderBy("i").collect()
    assert [g.c for g in got] == [plain(t) for t in texts]


def test_support_by_rule(spark):
    cases = [("P-gpの基質", "P-gp", None), ("p 糖蛋白", "p-GP", ""), ("BC-RP", "BCRP", None), ("CYP3A4", "CYP3A5", "3 A_4"), ("x", None, None), ("", "QT", ""), ("q-t", "QT", None), ("none", "-", " ")]
    want = [True, True, True, True, False, False, True, False]
    assert [TARGETS.supported(*c) for c in cases] == want
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, e string, c string, n string")
    assert [r.s for r in df.select("i", TARGETS.supported_column(F.col("e"), F.col("c"), F.col("n")).alias("s")).orderBy("i").collect()] == want
    own = TargetTable([], {}, {"Z": ("zed",)})
    assert own.supported("The Z E-D", "z", None) and not own.supported("Z", "Z", None)
    assert text.compact_text("A・b‑C d_e") == "abcde"
