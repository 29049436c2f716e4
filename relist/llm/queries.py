"""The registered queries of this subpackage, over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, fresh_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

#: crc32 of the id as text, bit by bit: DuckDB has no such function
CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(cast(doc_id as varchar), ''),
    lambda ch: [cast(ascii(ch) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, v: case when v >= 0 then xor(c, v) else xor(c >> 1, case when c & 1 = 1 then 3988292384 else 0 end) end))"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash_dedup import hex_digits, near_duplicates
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import matches
    return matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify
    return identify(_table(spark, sf_dir, "documents"))


ORACLE["op5_substring_dedup"] = r"""
with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
win as (select doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') as s
        from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d where len(w) >= 13)),
low as (select s, min(doc_id) as m from win group by s),
gone as (select distinct doc_id, i + k as p from (select win.doc_id, win.i from win join low using (s) where m < win.doc_id),
         range(0, 13) as r(k)),
word as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from d),
kept as (select word.doc_id, string_agg(x, ' ' order by p) as t, count(*) as n
         from word left join gone using (doc_id, p) where gone.p is null group by word.doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
"""


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import dedup_substrings
    return dedup_substrings(_table(spark, sf_dir, "documents"))


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepieces import round_trip
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    done = round_trip(docs)
    return done.select("doc_id", "n_tokens", "n_byte_tokens", "ids_sha256",
                       F.sha2(F.col("text").cast("binary"), 256).eqNullSafe(F.col("sha")).alias("exact"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan
    found = scan(_table(spark, sf_dir, "documents"), fresh_path(spark, "ledger"), "doc_id")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "blob")


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linededup import dedup_lines
    done = dedup_lines(_table(spark, sf_dir, "documents"), sketch=6)
    return done.select("doc_id", "n_lines", (F.col("n_lines") - F.col("kept_lines")).alias("n_removed"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pagetext import main_text
    return main_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_documents
    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


ORACLE["op11_merkle_manifest"] = rf"""
with recursive f as (select doc_id, source, text, {CRC} & 1 = 0 as bad,
       list_transform([cast(doc_id as varchar), source, lang, cast(n_chars as varchar)],
                      lambda x: coalesce(strlen(x) || ':' || x, '-')) as head from documents),
leaves as (select doc_id, source, sha256(array_to_string(head, '') || coalesce(strlen(text) || ':' || text, '-')) as leaf,
       case when bad then replace(text, chr(10), '') else text end as t, head from f),
l as (select doc_id, source, leaf, sha256(array_to_string(head, '') || coalesce(strlen(t) || ':' || t, '-')) as other,
       row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos from leaves),
tree as (select source, 0 as level, pos, leaf as h from l
       union all select source, level + 1, pos // 3, sha256(string_agg(h, '' order by pos))
       from (select *, count(*) over (partition by source) as c from tree) where c > 1 group by source, level, pos // 3),
sub as (select source, arg_max(h, level) as subroot, max(level) as top from tree group by source),
crown as (select 0 as level, row_number() over (order by source nulls first) - 1 as pos, subroot as h from sub
       union all select level + 1, pos // 3, sha256(string_agg(h, '' order by pos))
       from (select *, count(*) over () as c from crown) where c > 1 group by level, pos // 3),
top as (select arg_max(h, level) as root, max(level) as levels from crown),
ranked as (select *, row_number() over (order by source nulls first) - 1 as pos from sub),
-- every place a leaf's line passes: in its source's tree, then among the subroots
line as (select l.doc_id, l.leaf, 0 as part, l.source, v as level, cast(floor(l.pos / pow(3, v)) as bigint) as pos
         from l join sub on l.source is not distinct from sub.source, unnest(range(0, top)) as u(v)
         union all
         select l.doc_id, l.leaf, 1, null, v, cast(floor(ranked.pos / pow(3, v)) as bigint)
         from l join ranked on l.source is not distinct from ranked.source, top, unnest(range(0, levels)) as u(v)),
node as (select 0 as part, source, level, pos, h from tree union all select 1, null, level, pos, h from crown),
seg as (select line.doc_id, line.leaf, line.part, line.level,
               coalesce(string_agg(n.h, '' order by n.pos) filter (n.pos < line.pos), '') as lft,
               coalesce(string_agg(n.h, '' order by n.pos) filter (n.pos > line.pos), '') as rgt
        from line join node n on n.part = line.part and n.source is not distinct from line.source and n.level = line.level
             and n.pos // 3 = line.pos // 3 group by all),
proof as (select doc_id, leaf, list(lft order by part, level) as ls, list(rgt order by part, level) as rs from seg group by all),
fold as (select l.doc_id, l.leaf, l.other as h, 1 as i, ls, rs from l left join proof using (doc_id, leaf)
         union all select doc_id, leaf, sha256(ls[i] || h || rs[i]), i + 1, ls, rs from fold where i <= coalesce(len(ls), 0))
select l.doc_id, l.leaf, subroot, root,
       sha256(coalesce(array_to_string(list_transform(range(1, len(ls) + 1), lambda i: ls[i] || rs[i]), ''), '')) as proof_sha256,
       fold.h as folded_root, fold.h = root as verified
from l join sub on l.source is not distinct from sub.source join fold on fold.doc_id = l.doc_id and fold.leaf = l.leaf
     and fold.i = coalesce(len(ls), 0) + 1, top
"""


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import document_manifest, proof_text
    done = document_manifest(_table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 2) == 0, F.translate("text", "\n", ""))
    return done.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                       F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")


ORACLE["op12_source_mixing"] = r"""
with d as (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size from documents),
s as (select source, cast(sum(size) as bigint) as source_size, cast(2 * sum(size) as bigint) as cap,
             [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as w from d group by source),
o as (select *, 1.5::double * sum(source_size) over () as budget, sum(w) over () as ws,
             coalesce(sum(cap) over (order by cap * 6 // w, source nulls last rows between unbounded preceding and 1 preceding), 0) as cb,
             coalesce(sum(w) over (order by cap * 6 // w, source nulls last rows between unbounded preceding and 1 preceding), 0) as wb from s),
j as (select *, (budget - cb::double) / (ws - wb)::double * w >= cap as is_full from o),
t as (select source, source_size, case when is_full then cap::double else
             (budget - coalesce(sum(cap) filter (is_full) over (), 0)::double)
             / (ws - coalesce(sum(w) filter (is_full) over (), 0))::double * w end as target from j),
r as (select *, case when source_size > 0 then cast(least(round(target / source_size * 1048576), 2097152) as bigint) else 0 end as rate,
             cast('0x' || substr(sha256('mix' || case when source is null then '~' else '=' || source end), 1, 5) as bigint) as shift from t),
p as (select d.doc_id, d.size, r.*, row_number() over (partition by d.source order by d.size, d.doc_id nulls first) - 1 as pos
      from d join r on d.source is not distinct from r.source)
select doc_id, size, source_size, target, size * ((((pos + 1) * rate + shift) >> 20) - ((pos * rate + shift) >> 20)) as taken from p
"""


@query
def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_documents
    return mix_documents(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op13_periodic_runs"] = rf"""
with d as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w, {CRC} as h from documents),
m as (select doc_id, w, h, len(w) as n, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a from d),
q as (select *, case when a is not null then 1 + (n - a) // (3 + (h // 10) % 8) end as p from m),
t as (select doc_id, case when a is null then w else
             list_concat(w[1:a], list_transform(range(a, n), lambda i: w[1 + a + (i - a) % p])) end as w from q),
word as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) - 1 as i, len(w) as n from t),
pair as (select u.doc_id, v.i - u.i as per, u.i from word u join word v on u.doc_id = v.doc_id and u.x = v.x and v.i > u.i
         where 3 * (v.i - u.i) <= u.n),
stretch as (select doc_id, per, min(i) as start, count(*) + per as length
            from (select *, i - row_number() over (partition by doc_id, per order by i) as k from pair) group by doc_id, per, k),
run as (select doc_id, start, length, min(per) as period from stretch where length >= greatest(24, 3 * per) group by all),
best as (select doc_id, arg_min((start, length, period), (-(length::decimal(38, 0) * 1000000000000 / period), start, period)) as b, count(*) as n_runs,
                string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as runs from run group by doc_id),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from run),
kept as (select doc_id, string_agg(x, ' ' order by i) as c from word anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, coalesce(n_runs, 0) as n_runs, cast(b[1] as bigint) as start, cast(b[2] as bigint) as length, cast(b[3] as bigint) as period,
       cast(1000 * b[2] // b[3] as bigint) as exponent_milli, sha256(coalesce(runs, '')) as runs_sha256, sha256(coalesce(c, '')) as collapsed_sha256
from d left join best using (doc_id) left join kept using (doc_id)
"""


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic import periodic_runs, planted
    return periodic_runs(_table(spark, sf_dir, "documents"), change=planted)
