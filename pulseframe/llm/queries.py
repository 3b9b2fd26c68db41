"""Registered queries of this package over the given tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import (
    decontaminate,
    fill_middle,
    html_text,
    language,
    lm_score,
    merkle,
    mixing,
    multi_index,
    near_dedup,
    secret_scan,
    substring_dedup,
    token_counts,
    url_filter,
)
from pulseframe.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def register(build):
        QUERIES[name] = build
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words inside test windows for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest().alias("items_sha256"), "contaminated"
    )


ORACLE["op5_benchmark_decontamination"] = r"""
with d as (
  select doc_id, row_number() over () as row_no,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), b as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null
), bw as (
  select distinct item_id, len(w_run) as n, array_to_string(w_run, ' ') as run
  from (select item_id, unnest([w[i:i+12] for i in range(1, greatest(len(w) - 11, 2))]) as w_run
        from b where len(w) > 0)
), lengths as (
  select distinct n from bw
), dw as (
  select doc_id, row_no, n, i, array_to_string(w[i:i+n-1], ' ') as run
  from (select doc_id, row_no, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lengths where len(w) >= n)
), hits as (
  select row_no, i, dw.n, item_id from dw join bw on dw.run = bw.run and dw.n = bw.n
), hit_words as (
  select row_no, count(distinct p) as n_hit
  from (select row_no, unnest(range(i, i + n)) as p from (select distinct row_no, i, n from hits))
  group by row_no
), hit_items as (
  select row_no, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct row_no, cast(item_id as varchar) as item from hits)
  group by row_no
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit_words using (row_no) left join hit_items using (row_no)
"""


def crc_mod(column: str, n: int):
    """Remainder of the CRC-32 of a value as text; null: null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs).drop("text")


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    model = language.train(docs.filter(~held_out))
    judged = language.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return judged.select("doc_id", "held_out", "lang_pred", "score")


@query("op9_lm_scoring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every document, learnt from six sevenths of them."""
    held_out = F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", held_out.alias("held_out"), (~held_out).alias("train")
    )
    scored = lm_score.score(docs)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op10_substring_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences that an earlier run covers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.substring_dedup(docs).select("doc_id", "n_sentences", "n_removed", "text")


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.classes(docs).select(F.col("doc").alias("doc_id"), "class_id")


@query("op8_nearest_neighbours")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return multi_index.neighbours(vectors, vectors.filter("vec_id % 100 = 0"))


@query("op3_url_filter")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for the url of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict")


@query("op6_source_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors and rate of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "source", "n_words", *[f"p_{d}" for d in mixing.DOMAINS], "rate")


@query("op2_html_extraction")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


@query("op11_merkle_manifest")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document, and the root that it leads to after half of the texts lost their line feeds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    changed = F.replace("text", F.lit("\n"), F.lit(""))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    docs = docs.select(
        "doc_id", "source",
        merkle.leaf(*fields, F.col("text")).alias("leaf"),
        merkle.leaf(*fields, F.when(crc_mod("doc_id", 2) == 0, changed).otherwise(F.col("text"))).alias("now"),
    )
    proofs = merkle.manifest(docs, "leaf", "source", "doc_id", ("now",))
    found = proofs.withColumn("folded", merkle.fold(F.col("now"), F.col("proof")))
    return found.select(
        "doc_id",
        *[merkle.as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        merkle.as_hex(merkle.proof_digest(F.col("proof"))).alias("proof_sha256"),
        merkle.as_hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


@query("op12_fill_in_middle")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's output, and of the text rebuilt from it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_middle.digests(fill_middle.output_pieces(docs))


@query("op13_secret_scan")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, through a new ledger."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, ["doc_id"], scratch_path(spark, "secret-ledger"), "first")
    findings = F.col("findings")
    base = [r.kind for r in secret_scan.BASE]
    return found.select(
        "doc_id",
        *[secret_scan.count(findings, k).alias(f"n_{k}") for k in base],
        F.sha2(secret_scan.listed(findings, base), 256).alias("base_sha256"),
        secret_scan.listed(findings, [r.kind for r in secret_scan.RULES]).alias("spans"),
    )


ORACLE["op11_merkle_manifest"] = r"""
with recursive docs as (
  select doc_id, source, row_number() over () as row_no,
         [cast(doc_id as varchar), source, lang, cast(n_chars as varchar), text] as v,
         list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(cast(doc_id as varchar), ''),
           lambda c: list_transform(range(8), lambda k: (unicode(c) >> k) & 1)))),
           lambda crc, b: xor(crc >> 1, case when (crc & 1) <> b then 3988292384 else 0 end)) as crc
  from documents
), hashed as (
  select doc_id, source, row_no,
         sha256(array_to_string(list_transform(v, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) as leaf,
         sha256(array_to_string(list_transform(v[:4] || [case when xor(crc, 4294967295) % 2 = 0 then replace(v[5], chr(10), '') else v[5] end],
                                               lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) as now
  from docs
), leaves as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
         count(*) over (partition by source) as n
  from hashed
), tree as (
  select source, 0 as level, pos, n, leaf as digest from leaves
  union all
  select source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos))
  from tree where n > 1 group by source, level, pos // 3, n
), subroots as (
  select source, level as height, digest, row_number() over (order by encode(source) nulls first) - 1 as pos,
         count(*) over () as n
  from tree where n = 1
), top as (
  select 0 as level, pos, n, digest from subroots
  union all
  select level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos))
  from top where n > 1 group by level, pos // 3, n
), runs as (
  select source, false as top, level, pos // 3 as run, list(digest order by pos) as kids
  from tree where n > 1 group by source, level, pos // 3
  union all
  select null, true, level, pos // 3, list(digest order by pos) from top where n > 1 group by level, pos // 3
), steps as (
  select row_no, level, (pos // cast(3 ** level as bigint)) % 3 as i, kids
  from leaves join runs on not top and leaves.source is not distinct from runs.source
                      and pos // cast(3 ** (level + 1) as bigint) = run
  union all
  select row_no, height + level, (s.pos // cast(3 ** level as bigint)) % 3, kids
  from leaves join subroots s on leaves.source is not distinct from s.source
              join runs on top and s.pos // cast(3 ** (level + 1) as bigint) = run
), proofs as (
  select row_no, list(array_to_string(kids[:i], '') order by level) as before,
         list(array_to_string(kids[i + 2:], '') order by level) as after
  from steps group by row_no
), folds as (
  select row_no, 0 as level, now as digest, coalesce(before, []) as before, coalesce(after, []) as after
  from leaves left join proofs using (row_no)
  union all
  select row_no, level + 1, sha256(before[level + 1] || digest || after[level + 1]), before, after
  from folds where level < len(before)
)
select doc_id, leaf, s.digest as subroot, t.digest as root,
       sha256(array_to_string(list_transform(list_zip(f.before, f.after), lambda p: p[1] || p[2]), '')) as proof_sha256,
       f.digest as folded_root, f.digest = t.digest as verified
from leaves join subroots s on leaves.source is not distinct from s.source
            join (select digest from top where n = 1) t on true
            join folds f on f.row_no = leaves.row_no and f.level = len(f.before)
"""


ORACLE["op12_fill_in_middle"] = r"""
with units as (
  select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u
  from documents
), drawn as (
  select *, len(u) as n, [cast('0x' || h[8 * k + 1:8 * k + 8] as bigint) for k in range(4)] as d from units
), placed as (
  select *, least(d[1] % (n + 1), d[2] % (n + 1)) as a, greatest(d[1] % (n + 1), d[2] % (n + 1)) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or d[3] % 100 >= 50 then 'plain'
              when d[4] % 100 < 80 then 'spm' else 'psm' end as form
  from drawn
), parts as (
  select *, array_to_string(u[:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s
  from placed
), made as (
  select doc_id, n, form, p, m, case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                                          else '<S>' || s || '<P>' || p || '<M>' || m end as o
  from parts
), back as (
  select *, instr(o, '<P>') as ip, instr(o, '<S>') as js, instr(o, '<M>') as im from made
)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars, sha256(o) as output_sha256,
       sha256(case form when 'plain' then o when 'psm' then substr(o, 4, js - 4) || substr(o, im + 3) || substr(o, js + 3, im - js - 3)
              else substr(o, ip + 3, im - ip - 3) || substr(o, im + 3) || substr(o, 4, ip - 4) end) as restored_sha256
from back
"""


ORACLE["op13_secret_scan"] = r"""
with docs as (
  select doc_id, row_number() over () as row_no, coalesce(text, '') as t from documents
), rules as (
  select * from (values
    ('assign', 0, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    ('access', 1, '(AKIA[A-Z0-9]+)', 1, 20),
    ('hex', 2, '([0-9a-f]+)', 1, 24),
    ('pem', 3, '(-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----)', 1, 1),
    ('jwt', 4, '(eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})', 1, 1)
  ) as r(kind, rank, pattern, part, least)
), matches as (
  select row_no, kind, rank, least, string_split_regex(t, pattern) as gaps, regexp_extract_all(t, pattern, 0) as whole,
         case part when 2 then regexp_extract_all(t, pattern, 2) else regexp_extract_all(t, pattern, 1) end as parts
  from docs, rules
), each as (
  select row_no, kind, rank, least, unnest(range(1, len(whole) + 1)) as i, unnest(whole) as w, unnest(parts) as p,
         unnest(gaps[:len(whole)]) as g
  from matches
), spans as (
  select row_no, kind, rank, len(p) >= least as good,
         sum(len(g) + len(w)) over (partition by row_no, kind order by i) - len(w) as start, len(w) as size
  from each
), found as (
  select row_no, kind, rank, start, kind || ':' || cast(start as bigint) || ':' || cast(start + size as bigint) as span
  from spans where good
)
select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
       count(*) filter (kind = 'hex') as n_hex,
       sha256(coalesce(string_agg(span, ',' order by start, rank) filter (rank < 3), '')) as base_sha256,
       coalesce(string_agg(span, ',' order by start, rank), '') as spans
from docs left join found using (row_no) group by row_no, doc_id
"""
