"""The registered queries of the training-data operators and their SQL, where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.bpe import encode_documents
from docloom.llm.fingerprints import fingerprint_documents
from docloom.llm.fm_index import find_contamination
from docloom.llm import kneser_ney
from docloom.llm.ngram_join import jaccard_groups
from docloom.llm.pii import replace_entities
from docloom.llm.secret_scan import find_secrets
from docloom.llm.substring_dedup import remove_repeats
from docloom.llm.time_partitions import write_partitions
from docloom.llm.token_counts import count_tokens
from docloom.llm.toxicity import score_documents
from docloom.llm.url_lists import filter_captures, host_of
from docloom.llm.whitening import whiten_vectors
from docloom.llm.workspace import Workspace, shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The key of the registered queries; a production run passes its own secret.
DEMO_KEY = "docloom-demonstration-key"


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(_table(spark, sf_dir, "documents").select("doc_id", "text"), key=DEMO_KEY)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_documents(_table(spark, sf_dir, "documents"), ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN, keep_ids=False)
    return rows.drop("ids")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = Workspace(spark, "token-counts").path("cache")
    return count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path=public_tokenizers.path("byte_bpe_50k.json"), cache_path=cache)


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_documents(_table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"), k=4, threshold=0.85)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("spans", "item_ids")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def _digest_number(text: str, start: int, digits: int) -> str:
    return f"cast(conv(substr(md5({text}), {start}, {digits}), 16, 10) as bigint)"


def captures_of(pages: DataFrame) -> DataFrame:
    """The tables hold no fetch dates: each URL's is drawn from its MD5, within four years from 2020-01-01."""
    return pages.select("page_id", "url", F.expr(f"date_add(date'2020-01-01', cast({_digest_number('url', 1, 6)} % 1461 as int))").alias("fetch_date"))


def entries_of(pages: DataFrame) -> DataFrame:
    """The tables hold no lists: hosts enter and leave a block and an allow list at dates drawn from their MD5.

    About six of sixteen hosts are listed, a quarter of these by their parent domain.
    """
    hosts = pages.select(host_of(F.col("url")).alias("host")).dropna().distinct()
    drawn = hosts.selectExpr(
        "case when substr(md5(host), 2, 1) < '4' and size(split(host, '[.]')) > 3 then regexp_extract(host, '^[^.]+[.](.+)$', 1) else host end as pattern",
        "case when substr(md5(host), 3, 1) < '3' then 'allow' else 'block' end as list_name",
        f"{_digest_number('host', 4, 5)} % 1200 as first_day",
        f"1 + {_digest_number('host', 9, 5)} % 500 as days",
        "substr(md5(host), 14, 1) < '8' as comes_back",
        "substr(md5(host), 1, 1) < '6' as listed",
    ).filter("listed")
    day = lambda n: F.expr(f"date_add(date'2020-01-01', cast({n} as int))")
    added = drawn.select("list_name", "pattern", F.lit("add").alias("action"), day("first_day").alias("entry_date"))
    removed = drawn.select("list_name", "pattern", F.lit("remove").alias("action"), day("first_day + days").alias("entry_date"))
    again = drawn.filter("comes_back").select("list_name", "pattern", F.lit("add").alias("action"), day("first_day + 2 * days").alias("entry_date"))
    return added.unionByName(removed).unionByName(again)


def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_captures(captures_of(pages), entries_of(pages))


#: A click's moment: its time, moved back by up to 21 ** 3 days for 16 of 128 ids, and to the Monday before for another 16.
_MOMENT = """
case when pmod(crc32(cast(cast(click_id as string) as binary)), 128) < 16
     then cast(ts as timestamp_ntz) - make_dt_interval(cast(power(pmod(crc32(cast(cast(click_id as string) as binary)), 128) + 6, 3) as int))
     when pmod(crc32(cast(cast(click_id as string) as binary)), 128) > 111
     then cast(trunc(cast(cast(ts as timestamp_ntz) as date), 'week') as timestamp_ntz)
     else cast(ts as timestamp_ntz) end
"""


def op11_time_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks that arrived before May 2024, and the files that stay or are written when all have come."""
    clicks = _table(spark, sf_dir, "clicks")
    early = F.coalesce(F.col("arrived_at").cast("timestamp_ntz") < F.expr("timestamp_ntz'2024-05-01 00:00:00'"), F.lit(False))
    how = {"moment": F.expr(_MOMENT), "order": ["arrived_at", "click_id"], "id_col": "click_id", "leaf_rows": 1 + clicks.count() // 500}
    folder = f"{shared_folder(spark)}/clicks-{uuid.uuid4().hex}"
    start = write_partitions(clicks.filter(early), folder, **how)
    return write_partitions(clicks, folder, **how, new=~early, before=start).files.drop("sum_a", "sum_b", "sum_c")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_vectors(_table(spark, sf_dir, "embeddings"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"))


_OP10_SQL = """
with seen as (
  select page_id, nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '[.]+$', ''), '') as host,
         cast(date '2020-01-01' + cast(cast('0x' || substr(md5(url), 1, 6) as bigint) % 1461 as integer) as date) as fetch_date
  from pages),
hosts as (select distinct host from seen where host is not null),
drawn as (
  select case when substr(md5(host), 2, 1) < '4' and len(string_split(host, '.')) > 3 then regexp_extract(host, '^[^.]+[.](.+)$', 1) else host end as pattern,
         case when substr(md5(host), 3, 1) < '3' then 'allow' else 'block' end as list_name,
         cast('0x' || substr(md5(host), 4, 5) as bigint) % 1200 as first_day,
         1 + cast('0x' || substr(md5(host), 9, 5) as bigint) % 500 as days,
         substr(md5(host), 14, 1) < '8' as comes_back
  from hosts where substr(md5(host), 1, 1) < '6'),
entries as (
  select list_name, pattern, 0 as ends, first_day as day from drawn
  union all select list_name, pattern, 1, first_day + days from drawn
  union all select list_name, pattern, 0, first_day + 2 * days from drawn where comes_back),
daily as (select list_name, pattern, cast(date '2020-01-01' + cast(day as integer) as date) as valid_from, max(ends) as ends from entries group by all),
valid as (
  select list_name, pattern, valid_from, valid_to from (
    select *, lead(valid_from) over (partition by list_name, pattern order by valid_from) as valid_to from daily) where ends = 0),
met as (
  select s.host, s.fetch_date, v.pattern, v.list_name, row_number() over (partition by s.host, s.fetch_date order by length(v.pattern) desc, v.list_name = 'allow' desc) as r,
         count(*) over (partition by s.host, s.fetch_date) as n_active
  from (select distinct host, fetch_date from seen) s join valid v
    on (s.host = v.pattern or ends_with(s.host, '.' || v.pattern)) and s.fetch_date >= v.valid_from and (v.valid_to is null or s.fetch_date < v.valid_to))
select page_id, seen.host, seen.fetch_date, coalesce(n_active, 0) as n_active, pattern, list_name, coalesce(list_name <> 'allow', false) as blocked
from seen left join met on seen.host = met.host and seen.fetch_date = met.fetch_date and r = 1
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = "'[^\\x20\\x09-\\x0D]+'"
_NAMED = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
#: Words have no space, so that runs of words joined by spaces are equal if and only if their words are.
_OP2_SQL = f"""
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) as w from documents),
windows as (select doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) as g from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from words where len(w) >= 50)),
least as (select g, min(doc_id) as first_id from windows group by g),
gone as (select distinct doc_id, p from (select doc_id, unnest(range(i, i + 50)) as p from windows join least using (g) where first_id < doc_id)),
each as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from words),
kept as (select doc_id, string_agg(word, ' ' order by p) as text from each anti join gone using (doc_id, p) group by doc_id),
lost as (select doc_id, count(*) as n from gone group by doc_id)
select doc_id, len(w) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from words left join lost using (doc_id) left join kept using (doc_id)
"""

_OP7_SQL = f"""
with recursive words as (select doc_id, regexp_extract_all({_LOWER}, {_SPACED}) as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 2)) as i from words where len(w) >= 4)
  union all select doc_id, array_to_string(w, ' ') from words where len(w) between 1 and 3),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (select x, y from pairs join sizes s on s.doc_id = x join sizes t on t.doc_id = y where 100 * c >= 85 * (s.n + t.n - c)),
edges as (select x as a, y as b from links union all select y, x from links),
reach(doc_id, other) as (select doc_id, doc_id from words union select doc_id, b from reach join edges on a = other)
select doc_id, coalesce(n, 0) as n_shingles, component_id from (select doc_id, min(other) as component_id from reach group by doc_id) left join sizes using (doc_id)
"""

_OP8_SQL = f"""
with words as (select doc_id, regexp_extract_all({_LOWER}, {_NAMED}) as w from documents),
items as (select item_id, regexp_extract_all({_LOWER}, {_NAMED}) as w from benchmark),
phrases as (
  select distinct item_id, 10 as n, array_to_string(w[i:i + 9], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 8)) as i from items where len(w) >= 10)
  union select item_id, len(w), array_to_string(w, ' ') from items where len(w) between 1 and 9),
runs as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from words, (select distinct n from phrases) where len(w) >= n)),
met as (select doc_id, n, i, item_id from runs join phrases using (n, g)),
hits as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from met) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids from (select distinct doc_id, cast(item_id as varchar) as s from met where item_id is not null) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hits using (doc_id) left join named using (doc_id)
"""

#: CRC-32 of an id's digits, bit by bit.
_CRC = "xor(list_reduce(list_concat([4294967295::bigint], list_transform(regexp_extract_all(cast(doc_id as varchar), '.'), lambda c: ascii(c)::bigint)), lambda x, y: list_reduce(list_concat([xor(x, y)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)), 4294967295::bigint)"


def _kneser_ney_sql(order: int = 3) -> str:
    """The model from its definition, for order 3: ' s' before and ' e' after a text stand for its marks."""
    discount = lambda n: f"select *, case when least(n1, n2, n3, n4) = 0 then 0.5 else least(greatest(1 - 2 * y * n2 / n1, 0.01), 0.99) end as d1, case when least(n1, n2, n3, n4) = 0 then 1.0 else least(greatest(2 - 3 * y * n3 / n2, 0.01), 1.99) end as d2, case when least(n1, n2, n3, n4) = 0 then 1.5 else least(greatest(3 - 4 * y * n4 / n3, 0.01), 2.99) end as d3 from (select *, case when n1 + n2 > 0 then n1 / (n1 + 2 * n2) end as y from (select count(*) filter (where c = 1)::double as n1, count(*) filter (where c = 2)::double as n2, count(*) filter (where c = 3)::double as n3, count(*) filter (where c = 4)::double as n4 from c{n}))"
    cut = lambda n: f"greatest(coalesce(c{n}.c, 0) - case when coalesce(c{n}.c, 0) = 0 then 0 when c{n}.c = 1 then d{n}.d1 when c{n}.c = 2 then d{n}.d2 else d{n}.d3 end, 0)"
    spare = lambda n: f"(d{n}.d1 * x{n}.k1 + d{n}.d2 * x{n}.k2 + d{n}.d3 * x{n}.k3)"
    stats = "sum(c)::double as t, count(*) filter (where c = 1) as k1, count(*) filter (where c = 2) as k2, count(*) filter (where c > 2) as k3"
    assert order == 3
    return f"""
with docs as (select doc_id, {_CRC} % 7 = 2 as held_out, list_append(regexp_extract_all({_LOWER}, {_SPACED}), ' e') as w from documents),
tokens as (select doc_id, held_out, w[i] as a, case when i > 1 then w[i - 1] else ' s' end as b, case when i > 2 then w[i - 2] else ' s' end as e from (select *, unnest(range(1, len(w) + 1)) as i from docs)),
raw as (select a, count(*) as c from tokens where not held_out group by a),
totals as (select coalesce(sum(c), 0)::double as n, count(*)::double as v from raw),
c3 as (select e, b, a, count(*) as c from tokens where not held_out group by all),
c2 as (select b, a, count(*) as c from c3 group by all),
c1 as (select a, count(*) as c from c2 group by all),
d3 as ({discount(3)}), d2 as ({discount(2)}), d1 as ({discount(1)}),
x3 as (select e, b, {stats} from c3 group by all), x2 as (select b, {stats} from c2 group by all), x1 as (select {stats} from c1),
p1 as (select doc_id, held_out, t.a, t.b, t.e, coalesce(raw.c, 0) as r, n, v, case when x1.t > 0 then {cut(1)} / x1.t + {spare(1)} / x1.t / (v + 1) else 1 / (v + 1) end as p
  from tokens t cross join totals cross join x1 cross join d1 left join c1 on c1.a = t.a left join raw on raw.a = t.a),
p2 as (select q.* exclude (p), case when x2.t > 0 then {cut(2)} / x2.t + {spare(2)} / x2.t * p else p end as p
  from p1 q cross join d2 left join c2 on c2.a = q.a and c2.b = q.b left join x2 on x2.b = q.b),
p3 as (select q.* exclude (p), case when x3.t > 0 then {cut(3)} / x3.t + {spare(3)} / x3.t * p else p end as p
  from p2 q cross join d3 left join c3 on c3.a = q.a and c3.b = q.b and c3.e = q.e left join x3 on x3.b = q.b and x3.e = q.e)
select doc_id, held_out, count(*) as n_tokens, count(*) filter (where r > 0) as n_known, any_value(n)::bigint as train_tokens, sum(log10((r + 1) / (n + v + 1))) as base_score, sum(log10(p)) as score
from p3 group by doc_id, held_out
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_toxicity": op4_toxicity,
    "op5_token_counts": op5_token_counts,
    "op6_kneser_ney": op6_kneser_ney,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_fingerprints": op9_fingerprints,
    "op10_url_lists": op10_url_lists,
    "op11_time_partitions": op11_time_partitions,
    "op12_whitening": op12_whitening,
    "op13_secret_scan": op13_secret_scan,
}

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": _OP2_SQL,
    "op6_kneser_ney": _kneser_ney_sql(),
    "op7_ngram_jaccard_join": _OP7_SQL,
    "op8_benchmark_decontamination": _OP8_SQL,
    "op10_url_lists": _OP10_SQL,
}
