"""The pipeline's stages against plain Python, alone and one after another."""

import hashlib
import random
import re

import pytest

pipeline = pytest.importorskip("corpus_pipeline")
P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = " ".join(f"b{i}" for i in range(14))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t)) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with clean, toxic, copied, contaminated and private documents, null and repeated ids."""
    path, r = tmp_path_factory.mktemp("tables"), random.Random(8)
    word = lambda: "".join(r.choice("aeioust") for _ in range(6))
    words = lambda n: [word() for _ in range(n)]
    rows, labels = [], []
    for i in range(240):
        w = words(30)
        if i % 4 == 0:
            w[3] = w[9] = r.choice(["idiot", "moron"])
        rows.append((i, " ".join(w)))
        labels.append((i, 0, int(i % 4 == 0)))
    base = words(60)
    near = [[*base] for _ in range(12)]
    for k, w in enumerate(near):
        for at in r.sample(range(60), k % 3):
            w[at] = word()
    rows += [(1000 + k, " ".join(w)) for k, w in enumerate(near)]
    rows += [(2000, f"{ITEM} and more"), (None, " ".join(words(9)) + " " + ITEM.upper()), (2001, "Write to Mr Adam Brown, a.b@x.com, 10.0.0.1 today please ok")]
    rows += [(None, " ".join(words(20))), (None, " ".join(words(20))), (3000, None), (3001, ""), (3000, " ".join(words(20))), (3000, rows[1][1]), (3002, "long " * 20000)]
    table(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


def run(spark, folder, name, rows):
    out = dict(pipeline.STAGES)[name](spark, table(spark, rows), folder[0])
    assert name == "token_ids" or out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str) if name != "token_ids" else out.collect()


def without_copies(rows):
    """Brute force: of each group of rows linked at 0.8 by five-word shingles the row with the least id stays."""
    sets = []
    for _, t in rows:
        w = WORDS.findall((t or "").lower())
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
                root[find(a)] = find(b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i])
    return sorted((min(g, key=lambda x: (x[0] is None, x[0] or 0)) for g in groups.values()), key=str)


def contaminated(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    item = ITEM.split()
    windows = {tuple(item[j : j + 10]) for j in range(len(item) - 9)}
    return any(tuple(w[j : j + 10]) in windows for j in range(len(w) - 9))


def test_toxicity(spark, folder):
    rows = folder[1]
    kept = run(spark, folder, "toxicity", rows)
    bad = [x for x in rows if re.search("idiot|moron", x[1] or "")]
    assert not set(bad) & set(kept) and len(kept) == len(rows) - len(bad)


def test_near_duplicates(spark, folder):
    kept = run(spark, folder, "near_duplicates", folder[1])
    want = without_copies(folder[1])
    assert [x[0] for x in kept] == [x[0] for x in want] and len(kept) < len(folder[1]) - 5


def test_decontamination(spark, folder):
    assert run(spark, folder, "decontamination", folder[1]) == sorted((x for x in folder[1] if not contaminated(x[1])), key=str)


def test_personal_data(spark, folder):
    got = run(spark, folder, "personal_data", folder[1])
    private = [x for x in got if x[0] == 2001][0][1]
    assert re.fullmatch(r"Write to Mr [A-Z]\w+n [A-Z]\w+n, \w\.\w@\w\.example, [0-9.]+ today please ok", private) and "Brown" not in private
    assert [x for x in got if x[0] != 2001] == sorted((x for x in folder[1] if x[0] != 2001), key=str)


def test_token_ids(spark, folder):
    tiktoken = pytest.importorskip("tiktoken")
    from docloom.llm.bpe import load_ranks

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(f.read()), special_tokens={})
    got = run(spark, folder, "token_ids", folder[1])
    want = sorted((str(i), len(x := library.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest(), str(x)) for i, t in folder[1])
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded_sha256, str(memoryview(r.ids).cast("I").tolist())) for r in got) == want


def test_run(spark, folder):
    got = pipeline.run(spark, folder[0]).collect()
    left = [x for x in folder[1] if not re.search("idiot|moron", x[1] or "")]
    left = [x for x in without_copies(left) if not contaminated(x[1])]
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in left)
    same = {hashlib.sha256((t or "").encode()).hexdigest() for i, t in left if i != 2001}
    assert same <= {r.decoded_sha256 for r in got}


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_empty_documents(spark, folder, name):
    assert run(spark, folder, name, []) == []
