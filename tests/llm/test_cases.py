"""Hard cases of the operators, each against plain Python: long texts, nulls, ties, copies, empty tables, clashing names, skew."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import arrays, bpe, blocks, fingerprints, fm_index, kneser_ney, ngram_join, pii, substring_dedup, token_counts, toxicity, url_lists

P = pytest.importorskip("public_tokenizers")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = "id long, text string, digest string, token string, kind string, mention string, a long, range int, `key` string, n_entities string"


def docs_of(spark, rows):
    """Extra columns have names that the operators use inside."""
    return spark.createDataFrame([(i, t, "x", None, "y", "z", 7, None, "k", "n") for i, t in rows], CLASH)


def twins():
    """Two different words of 1,024 letters whose sums over powers of any odd number are equal modulo 2**64."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_different_words_never_count_as_equal(spark):
    a, b = twins()
    got = ngram_join.jaccard_groups(docs_of(spark, [(1, a), (2, b)]), id_col="id").collect()
    assert sorted(r.component_id for r in got) == [1, 2]
    tail = " ".join(f"w{i}" for i in range(4))
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs_of(spark, [(1, f"{a} {tail}"), (2, f"{b} {tail}"), (3, f"{a} {tail}")]), id_col="id", width=5, batches=1).collect()}
    assert got == {1: 0, 2: 0, 3: 5}
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    train = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2)
    got = {r.doc_id: r.n_known for r in kneser_ney.score_documents(docs_of(spark, [(train, a), (held, b)]), id_col="id").collect()}
    assert got == {train: 2, held: 1}


def test_words_are_told_apart_by_bytes(monkeypatch):
    buf = arrays.np.frombuffer(b"aa bb aa cc bb aa", dtype=arrays.np.uint8)
    starts, ends, _ = arrays.word_spans(buf, arrays.np.array([0, len(buf)]), arrays.SPACES)
    want = arrays.dense_words(buf, starts, ends).tolist()
    monkeypatch.setattr(arrays, "hash_spans", lambda b, s, e, seed=0: arrays.np.zeros(len(s), dtype=arrays.U))
    got = arrays.dense_words(buf, starts, ends).tolist()
    same = lambda x: [[u == v for u in x] for v in x]
    assert same(got) == same(want) == same([0, 1, 0, 2, 1, 0])
    pairs = same(arrays.dense_grams(arrays.np.array(got), 2).tolist())
    monkeypatch.setattr(arrays, "grams", lambda w, k, salt=0: arrays.np.zeros(len(w) - k + 1, dtype=arrays.U))
    assert same(arrays.dense_grams(arrays.np.array(got), 2).tolist()) == pairs == same([0, 1, 2, 3, 1])


def small_corpus(n, seed=5):
    r = random.Random(seed)
    rows = [(i, " ".join(f"w{min(r.randint(0, 400), r.randint(0, 400))}" for _ in range(r.randint(0, 60)))) for i in range(n)]
    return [*rows, (n + 1, rows[3][1] + " tail"), (n + 2, rows[3][1]), (n + 3, None), (n + 4, "")]


@pytest.mark.parametrize("fan", [1, 2])
def test_relays_change_no_result(spark, monkeypatch, fan):
    rows = small_corpus(120)
    ask = {
        "op2": lambda: substring_dedup.remove_repeats(docs_of(spark, rows), id_col="id", width=8, batches=2).drop("kept"),
        "op6": lambda: kneser_ney.score_documents(docs_of(spark, rows), id_col="id").select("doc_id", "n_known", F.round("score", 9)),
        "op7": lambda: ngram_join.jaccard_groups(docs_of(spark, rows), id_col="id", k=3, threshold=0.6),
    }
    want = {k: sorted(map(tuple, f().collect())) for k, f in ask.items()}
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 900)
    monkeypatch.setattr(blocks, "SHARD_BYTES", 1200)
    monkeypatch.setattr(blocks, "FAN_BITS", fan)
    for k, f in ask.items():
        assert sorted(map(tuple, f().collect())) == want[k], k


def test_messages_grow_with_the_text(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(blocks, "SHARD_BYTES", 2000)
    monkeypatch.setattr(blocks, "FAN_BITS", 2)

    def arrays_sent(n):
        ws = substring_dedup.Workspace(spark, "count")
        own = blocks.write_blocks(docs_of(spark, small_corpus(n)), ws, "blocks", "id", "text")
        size = blocks.size_of(own)
        told = blocks.messages(own, ngram_join._df_message(40, 3), 40, size)
        each, per = [told.select(F.sum(F.size("blocks")).alias("n")).first().n], size.n_blocks << size.fan_bits
        for level in range(1, size.levels):
            told = told.groupBy("slot", "shard").applyInArrow(blocks._relay(level, 40, size), blocks.MESSAGE_SCHEMA)
            each.append(told.select(F.sum(F.size("blocks")).alias("n")).first().n)
        assert size.levels > 1 and all(x <= 1.2 * (4**i) * per for i, x in enumerate(each))
        return each[0], size

    (few, a), (many, b) = arrays_sent(100), arrays_sent(800)
    assert b.shard_bits > a.shard_bits and 6 < many / few < 10


def test_a_stored_model_scores_other_texts(spark, monkeypatch, tmp_path):
    """As the documents that it was fitted on, if they are the same; in shards of another size too."""
    rows = small_corpus(80)
    want = {r.doc_id: r for r in kneser_ney.score_documents(docs_of(spark, rows), id_col="id", model_path=str(tmp_path / "model")).collect()}
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(blocks, "SHARD_BYTES", 3000)
    got = kneser_ney.score_texts(docs_of(spark, [*rows, (None, "words that nobody has")]), str(tmp_path / "model"), id_col="id").collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r.doc_id is not None:
            w = want[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (w.n_tokens, w.n_known, w.train_tokens)
            assert r.score == pytest.approx(w.score) and r.base_score == pytest.approx(w.base_score)
        else:
            assert (r.n_tokens, r.n_known) == (5, 1)


# --- op1


def replaced(spark, texts, key="k"):
    got = {r.id: r for r in pii.replace_entities(docs_of(spark, list(enumerate(texts))), key=key, id_col="id").collect()}
    return [got[i].text for i in range(len(texts))], [got[i].n_entities for i in range(len(texts))]


def test_pii_long_texts_end(spark):
    big = 200_000
    texts = ["x@" + "a." * 5000 + "com 10.0.0.1", "a." * big, "1" * big, "1 " * big, "." * big, "@" * big, "Mr " * big, "x@x" * big, "0123456789abcdef" * (big // 16), "+1 " * big, "é " * big, "Mr " + "A" * 300 + " B"]
    out, n = replaced(spark, texts)
    assert n[0] == 1 and "10.0.0.1" not in out[0] and out[1] == texts[1] and out[4:6] == texts[4:6]


def classes(s):
    return re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"[0-9]", "0", s)))


def test_pii_format(spark):
    r = random.Random(7)
    pick = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    low, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mails = [f"{pick(low, r.randint(4, 40))}.{pick(low + digits, 9)}@{pick(low, r.randint(9, 60))}.{pick(low, 8)}.org" for _ in range(60)]
    mails += ["a@departmentofphysicsandastronomy.org", "Some.One@Example-Host.COM"]
    other = [f"{pick('123456789', 3)}-{pick(digits, 2)}-{pick(digits, 4)}" for _ in range(30)] + ["AKIA" + pick("ABCDEFGH234567", 16) for _ in range(30)] + [pick("0123456789abcdef", 40) + "0" for _ in range(30)]
    phones = [f"+{c} ({pick('23456789', 3)}) {pick(digits, 3)}-{pick(digits, 4)}" for c in (1, 44, 81) for _ in range(10)]
    texts = [*mails, *other, *phones]
    out, n = replaced(spark, texts)
    assert n == [1] * len(texts) and len(set(out)) == len(texts) and not set(out) & set(texts)
    for before, after in zip(texts, out):
        if "@" in before:
            assert classes(before.rsplit(".", 1)[0]) == classes(after.rsplit(".", 1)[0]) and after.lower().endswith(".example")
        else:
            assert classes(before) == classes(after)
    assert all(a.split(" ")[0] == b.split(" ")[0] for a, b in zip(phones, out[-len(phones) :]))


def test_pii_names(spark):
    texts = ["Mr John Smith", "Mrs John Smith", "Mr Smith", "Dr Smith and MR SMITH", "Dr John Smith", "Mr Smith's car", "Frau Weber", "Dr Weber", "Dr Nobody", "Господин Иванов", "(858) 555-7260", "+1 858-555-7260", "MRS JANE SMITH", None, ""]
    out, n = replaced(spark, texts)
    word = lambda i: out[i].split(" ")[1:]
    assert n[-2:] == [0, 0] and out[-2:] == [None, ""]
    base = word(0)[0][:-1]
    assert word(0)[0] == base + "n" and word(1)[0] == base + "a"  # one base, the gender of the mention's title
    assert word(2)[0] == word(0)[1] and word(5)[0] == word(2)[0] + "'s"  # the surname alone
    assert word(4)[0] == base and word(4)[1] == word(2)[0][:-1]  # no title tells, and others disagree
    assert out[6].split()[1] == out[7].split()[1] and out[6].endswith("a")  # the only other mention tells
    assert re.fullmatch("Господин [А-Я][а-я]+в", out[9])
    assert re.sub("[^0-9]", "", out[10]) == re.sub("[^0-9]", "", out[11])[1:]
    assert out[12] == out[12].upper() or out[12].startswith("MRS")


def test_pii_meets_no_real_entity(spark):
    first, _ = replaced(spark, ["Mr John Smith", "a.b@x.com", "10.1.2.3", "123-45-6789"])
    real = ["Mr John Smith", "a.b@x.com", "10.1.2.3", "123-45-6789"]
    out, _ = replaced(spark, [*real, *(f"see {x} here" for x in first)])
    taken = {w.lower() for x in (*real, *first) for w in re.split(r"[ ]", x)} - {"mr", "see", "here"}
    assert len(set(out)) == len(out)
    for x in out:
        assert not {w.lower() for w in x.split(" ")} & taken, x


def test_pii_marks_and_names_of_columns(spark):
    texts = [f"odd {pii.MARK} a.b@x.com{pii.MARK}10.0.0.1", "a.b@x.com10.0.0.1", "a.b@x.com"]
    out, n = replaced(spark, texts)
    assert n[0] == 2 and out[0].count(pii.MARK) == 2 and out[0].split(pii.MARK)[1].strip() == out[2]
    rows = pii.replace_entities(docs_of(spark, [(None, "a.b@x.com"), (None, "a.b@x.com"), (1, None)]), key="k", id_col="id")
    assert rows.columns == ["id", "text", "digest", "token", "kind", "mention", "a", "range", "key", "n_entities"]
    assert sorted((r.id is None, r.n_entities, r.digest, r.key) for r in rows.collect()) == [(False, 0, "x", "k"), (True, 1, "x", "k"), (True, 1, "x", "k")]


# --- op3, op5


def odd_texts(n, seed=9):
    r = random.Random(seed)
    parts = ["a", "the", " ", "  ", "\n", "é", "日本", "'s", "12", "!", "\x1c", "　", " ", "\xa0", "<|endoftext|>", "x" * 90, "р", "\x85", "\x7f", "“", "— ", "word "]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(n)] + ["", " ", "y" * 3000, " y" * 3000]


def test_token_counts_and_ids(spark, tmp_path):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("tokenizers")
    texts = odd_texts(300)
    rows = [*enumerate(texts), (None, "null id"), (0, texts[0]), (9999, None)]
    json_path, ranks_path = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
    library = tokenizers.Tokenizer.from_file(json_path)
    got = token_counts.count_tokens(docs_of(spark, rows), tokenizer_path=json_path, cache_path=str(tmp_path / "c"), limit=2000, id_col="id").collect()
    want = sorted((str(i), len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2000) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    with open(ranks_path, "rb") as f:
        ranks = bpe.load_ranks(f.read())
    for pattern in (P.PATTERN, r"[a-z]+|[^a-z]"):  # the second can't be cut into parts
        own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        ids = bpe.encode_documents(docs_of(spark, rows), ranks_path=ranks_path, pattern=pattern, id_col="id").collect()
        told = lambda t: (x := arrays.np.array(own.encode_ordinary(t or ""), dtype="<u4").tobytes(), hashlib.sha256(x).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        assert sorted((str(r.doc_id), r.ids, r.ids_sha256, r.decoded_sha256) for r in ids) == sorted((str(i), *told(t)) for i, t in rows)


def test_other_tokenizers_read_whole_texts(spark, tmp_path):
    word, piece = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
    assert not token_counts.Counter(word).cut and token_counts.Counter(P.path("byte_bpe_50k.json")).cut
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(word)
    texts = odd_texts(40)
    assert token_counts.Counter(word).counts_of(pa.array(texts)).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=piece)
    assert token_counts.Counter(piece).counts_of(pa.array([*texts, None])).tolist() == [*(len(library.encode(t)) for t in texts), len(library.encode(""))]


def test_cache_is_read_and_nothing_encoded_twice(spark, tmp_path):
    path, cache = P.path("byte_bpe_50k.json"), str(tmp_path / "cache")
    count = lambda rows: token_counts.count_tokens(docs_of(spark, rows), tokenizer_path=path, cache_path=cache, id_col="id")
    rows = [(i, f"text {i % 7}") for i in range(50)]
    first = sorted(map(tuple, count(rows).collect()))
    stored = spark.read.parquet(f"{cache}/append-*")
    assert stored.count() == 7
    stored.withColumn("n_tokens", F.lit(1000).cast("bigint")).write.parquet(f"{cache}/append-other")  # what the cache says is taken
    assert {r.n_tokens for r in count(rows).collect()} == {1000} and len(first) == 50
    assert count([]).count() == 0


# --- op8


def test_decontamination_brute_force(spark):
    r = random.Random(3)
    word = lambda: r.choice(["Ab", "c3", "é", "X", "yy", "z-"])
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(r.randint(0, 7))) for i in range(25)] + [(3, text(5)), (None, text(5)), (77, None), (78, ""), (79, "--")]
    rows = [(i, text(r.randint(0, 60))) for i in range(60)] + [(5, text(20)), (None, text(20)), (90, None), (91, ""), (92, "c3 " * 20000)]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - 3) if w else 0):
            windows.setdefault(tuple(w[j : j + 4]), set()).add(i)
    want = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[j : j + n]))) is not None:
                    hit.update(range(j, j + n))
                    found |= own - {None}
        want.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    for limit in (1 << 20, 60):
        got = fm_index.find_contamination(docs_of(spark, rows), bench, id_col="id", width=4, pattern_bytes=limit, shard_bytes=2000).collect()
        assert sorted((str(x.doc_id), x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) for x in got) == sorted(want)
    assert fm_index.find_contamination(docs_of(spark, []), bench, id_col="id").count() == 0
    assert {x.n_hit for x in fm_index.find_contamination(docs_of(spark, rows), bench.limit(0), id_col="id").collect()} == {0}


# --- op9


def canon(t):
    import unicodedata

    fold = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t or "").casefold())
    return re.sub(r"[\s\x1c-\x1f\x85\xa0 -     　]+", " ", fold).strip(" ")


def fingerprint_rows(seed, ids):
    r = random.Random(seed)
    parts = ["Straße", "STRASSE", "ﬁne", "fine", "é", "é", " ", "  ", "\n", "Ａ", "a", "x"]
    return [(ids(r, i), None if r.random() < 0.05 else "".join(r.choice(parts) for _ in range(r.randint(0, 6)))) for i in range(150)]


@pytest.mark.parametrize("collide", [False, True])
@pytest.mark.parametrize("ids", ["unique", "hot"])
def test_fingerprints_brute_force(spark, monkeypatch, ids, collide):
    """Small ranges; a third of the rows without an id; all hashes equal, so that bytes alone tell texts apart."""
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 5)
    monkeypatch.setattr(fingerprints, "FAN", 4)
    if collide:
        monkeypatch.setattr(fingerprints, "hashes", lambda c: [F.length(c) * 0, F.length(c).cast("bigint") * 0])
    make = {"unique": lambda r, i: i * 37 % 151, "hot": lambda r, i: None if i % 3 == 0 else 7 if i % 3 == 1 else i}[ids]
    rows = fingerprint_rows(4, make)
    got = fingerprints.fingerprint_documents(docs_of(spark, rows), id_col="id").collect()
    assert len(got) == len(rows) and {r.fingerprint for r in got if collide} <= {"0" * 32}
    least = {}
    for i, t in rows:
        least[canon(t)] = min((x for x in (least.get(canon(t)), i) if x is not None), default=None)
    tell = lambda i, t: (str(i), len(t or ""), str(least[canon(t)]))
    assert sorted((str(r.doc_id), r.n_chars, str(r.group_doc_id)) for r in got) == sorted(tell(i, t) for i, t in rows)
    if ids == "unique":
        order = [t or "" for _, t in sorted(rows)]
        for j, r in enumerate(sorted(got, key=lambda r: r.doc_id)):
            t, following = order[j], order[(j + 1) % len(order)]
            half = len(t) // 2
            edited = t[: len(t) - half] + following[:half]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert (r.near_edited, r.near_next) == (float(canon(t) == canon(edited)), float(canon(t) == canon(following)))
            if not collide:
                assert (r.fingerprint == r.edited_fingerprint) == (canon(t) == canon(edited))


def test_one_row_is_its_own_next(spark):
    r = fingerprints.fingerprint_documents(docs_of(spark, [(1, "abcd")]), id_col="id").first()
    assert r.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and r.near_next == 1.0


# --- op4, op10, empty tables


def test_toxicity_cases(spark):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (1, 0)], "doc_id long, toxic int")
    rows = [(1, "you idiot"), (1, "you idiot"), (2, None), (3, ""), (None, "fine"), (4, "idiot " * 100_000), (5, "good word " * 50_000)]
    got = toxicity.score_documents(docs_of(spark, rows), labels, id_col="id").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[2] == score[3]
    none = labels.limit(0)
    assert toxicity.score_documents(docs_of(spark, []), none, id_col="id").count() == 0
    assert toxicity.score_documents(docs_of(spark, rows), none, id_col="id").count() == len(rows)


def test_bags_are_bounded():
    many = arrays.np.arange(1, 300_000, dtype=arrays.U)
    bag = toxicity.bag_of(many, many)
    assert bag.size == 2 * len(many) and len(bag.slots) <= 1 << toxicity.HASH_BITS


def test_url_lists_cases(spark):
    pages = spark.createDataFrame([(1, "http://a.com", None, 1), (None, "http://a.com", "2020-01-02", 2), (2, "", "2020-01-02", 3), (2, "http://A.com.", "2020-01-02", 4), (2, "http://a.com", "2020-01-02", 5)], "page_id long, url string, fetch_date string, pattern int")
    entries = spark.createDataFrame([("block", "a.com", "add", "2020-01-01"), ("block", "a.com", "add", "2020-01-01"), ("block", "com", "add", None)], "list_name string, pattern string, action string, entry_date string")
    got = url_lists.filter_captures(pages, entries).collect()
    assert sorted((str(r.page_id), r.blocked, r.n_active) for r in got) == [("1", False, 0), ("2", False, 0), ("2", True, 1), ("2", True, 1), ("None", True, 1)]
    assert url_lists.filter_captures(pages.limit(0), entries).count() == 0
    assert {r.blocked for r in url_lists.filter_captures(pages, entries.limit(0)).collect()} == {False}
    white = entries.withColumn("list_name", F.lit("trusted"))
    assert {r.blocked for r in url_lists.filter_captures(pages, white, allow_lists=("trusted",)).collect()} == {False}


def test_empty_tables(spark, tmp_path):
    none = docs_of(spark, [])
    assert bpe.encode_documents(none, ranks_path=P.path("byte_bpe_50k.tiktoken"), pattern=P.PATTERN, id_col="id").count() == 0
    assert token_counts.count_tokens(none, tokenizer_path=P.path("byte_bpe_50k.json"), cache_path=str(tmp_path / "c"), id_col="id").count() == 0
    assert pii.replace_entities(none, key="k", id_col="id").count() == 0
    assert fingerprints.fingerprint_documents(none, id_col="id").count() == 0


def test_long_names_are_replaced_whole(spark):
    long = "A" + "bcdefghij" * 12
    rows = [(1, f"Mr {long} and Mrs Jane {long}'s dog"), (2, "Mr " + "Z" + "y" * 50_000 + ".")]
    for r in pii.replace_entities(docs_of(spark, rows).select("id", "text"), key="k", id_col="id").collect():
        assert "bcdefghij" not in r.text and "yyyy" not in r.text, r.text[:300]
