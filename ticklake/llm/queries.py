"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import bpe, embedding_dedup, hard_negatives, merkle, minhash, mixing, pii, sharding, suffix_dedup, token_ids, topk, toxicity, warc
from ticklake.llm.common import ship_package, table
from ticklake.session import scratch_dir

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Of the registered query; a deployment passes its own secret.
PSEUDONYM_KEY = b"registered query"
TOKENIZER, END_ID = "word_bpe_49k.json", 1


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    return run


@_query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.bpe_digests(docs, "text", public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@_query
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


@_query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), shards=16)


@_query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixture(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


@_query
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


@_query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"), least_bytes=0)


@_query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.toxicity(docs, table(spark, sf_dir, "labels"), threshold=0.7)
    return out.select("doc_id", "held_out", "score", "predicted")


@_query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.without_personal_data(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    kinds = F.array_join(F.array_sort(F.transform(F.map_entries("found"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))), ",")
    values = F.aggregate(F.map_values("found"), F.lit(0).cast("long"), lambda a, b: a + b)
    return out.select("doc_id", "text", values.alias("n_values"), kinds.alias("kinds"))


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), every=50, positives=5, negatives=3, low=50, high=95, scale=256.0)


@_query
def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token_ids")
    token_ids.write_token_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_ids.read_token_ids(spark, path, ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = {"text": F.translate("text", string.ascii_uppercase, string.ascii_lowercase)}
    tampered = merkle.leaf(*[lowered.get(c, F.col(c)) for c in fields])
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = merkle.manifest(docs, fields, id_col="doc_id", tree_col="lang", carry={"tampered": F.when(changed, tampered)})
    out = out.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf")))
    return out.select("doc_id", "leaf", "subroot", "root", merkle.proof().alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_minhash_near_dedup,
        op3_sharding,
        op4_source_mixing,
        op5_embedding_near_dedup,
        op6_exact_top_k,
        op7_warc,
        op8_suffix_dedup,
        op9_toxicity,
        op10_pii,
        op11_hard_negatives,
        op12_token_ids,
        op13_merkle_manifest,
    )
}

#: The same targets and the same hashes as op4; there the rows of a source are
#: put in hash order and taken while their running sum is within the budget, and
#: one hash value more if that ends nearer.
_OP4 = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 12))::bigint as hash
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         1 + (row_number() over (order by encode(source) nulls last) - 1) % 3 as weight
  from sized group by source),
ordered as (
  select *, 3 * coalesce(sum(source_size) over (by_ratio rows between unbounded preceding and 1 preceding), 0) as before,
         sum(weight) over (by_ratio rows between current row and unbounded following) as weight_left,
         sum(source_size) over () as total
  from sources window by_ratio as (order by source_size / weight, encode(source) nulls last)),
capped as (
  select *, weight * (total - before) > 3 * source_size * weight_left as capped from ordered),
levels as (
  select max(total - before) as level_sum, max(weight_left) as level_weight from capped where not capped),
targets as (
  select source, source_size,
         case when capped then source_size::double * 3
              else coalesce((weight * level_sum)::double / level_weight::double, 0.0) end as target
  from capped, levels),
budgets as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as base from targets),
hashes as (
  select s.source, s.hash, sum(s.size)::double as words from sized s group by s.source, s.hash),
running as (
  select h.source, h.hash, h.words, b.target - b.base * b.source_size as budget,
         sum(h.words) over (partition by h.source order by h.hash) as upto
  from hashes h join budgets b on h.source is not distinct from b.source),
taken_more as (
  select source, hash, upto <= budget or (upto - words <= budget and upto - budget < budget - (upto - words)) as more
  from running)
select s.doc_id, s.size, b.source_size, b.target,
       (s.size * (b.base + case when t.more then 1 else 0 end))::bigint as taken
from sized s join budgets b on s.source is not distinct from b.source
     join taken_more t on s.source is not distinct from t.source and s.hash = t.hash
"""

_OP6 = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as v
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 100 = 0),
ranked as (
  select *, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

_OP11 = """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
         list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::bigint as score
  from usable a join usable r on a.vec_id <> r.vec_id and len(a.v) = len(r.v)
  where a.vec_id % 50 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score
  from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as n from scored where same)
  where n <= 5),
negatives as (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
         (row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id))::int as rank
  from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
   and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 3
"""

#: All pairs that share a shingle, then whatever links reach.
_OP2 = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) < 2 then w else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s from worded),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (
  select p.a, p.b from shared p join sizes x on x.doc_id = p.a join sizes y on y.doc_id = p.b where 100 * p.n >= 80 * (x.n + y.n - p.n)),
reach as (
  select doc_id, doc_id as r from documents
  union select reach.doc_id, links.b from reach join links on links.a = reach.r)
select d.doc_id, coalesce(any_value(s.n), 0) as n_shingles, min(reach.r) as component_id, min(reach.r) = d.doc_id as kept
from documents d join reach on reach.doc_id = d.doc_id left join sizes s on s.doc_id = d.doc_id group by d.doc_id
""".format(upper=string.ascii_uppercase, lower=string.ascii_lowercase)

_OP5 = """
with recursive usable as (
  select vec_id, label, embedding::double[] as v from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.98),
counted as (select a, count(*) as n from links group by a),
reach as (
  select vec_id, vec_id as r from embeddings
  union select reach.vec_id, links.b from reach join links on links.a = reach.r)
select e.vec_id, coalesce(any_value(c.n), 0) as n_links, min(reach.r) as component_id, min(reach.r) = e.vec_id as kept
from embeddings e join reach on reach.vec_id = e.vec_id left join counted c on c.a = e.vec_id group by e.vec_id
"""

#: 40 hex digits are 8 times 20 bits, each 4 digits of base 32.
_OP7 = """
with hashed as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
digested as (
  select page_id, html, array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * i + 1, 5))::bigint >> b::int) & 31) + 1, 1)), '')), '') as payload_digest
  from hashed),
last as (select *, max(page_id) over (partition by html) as response from digested)
select page_id, strlen(html)::bigint as payload_bytes, payload_digest, case when page_id = response then 'response' else 'revisit' end as record_type,
       case when page_id <> response then response end as refers_to
from last
"""

#: Levels that the SQL of op13 has: trees of up to 8**8 documents of a language, 8**4 languages.
_TREE_LEVELS, _TOP_LEVELS = 8, 4


def _levels(name: str, leaves: str, members: str, levels: int) -> list[str]:
    """Node levels <name>0.. over `leaves` (tree, pos, n, digest), and what
    `members` (tree, pos, acc, proof and other columns) become level by level."""
    ctes = [f"{name}0 as (select tree, pos, n, digest from {leaves})", f"{name}_up0 as (select * from {members})"]
    for k in range(levels):
        runs = f"select tree, pos // 8 as run, n, list(digest order by pos) as ds from {name}{k} group by tree, pos // 8, n"
        ctes.append(f"{name}_runs{k} as ({runs})")
        ctes.append(
            f"{name}{k + 1} as (select tree, run as pos, case when n > 1 then (n + 7) // 8 else 1 end as n, "
            f"case when n > 1 then sha256(array_to_string(ds, '')) else ds[1] end as digest from {name}_runs{k})"
        )
        left, right = "array_to_string(r.ds[1:m.pos % 8], '')", "array_to_string(r.ds[m.pos % 8 + 2:], '')"
        ctes.append(
            f"{name}_up{k + 1} as (select m.* replace (m.pos // 8 as pos, "
            f"case when r.n > 1 then sha256({left} || m.acc || {right}) else m.acc end as acc, "
            f"case when r.n > 1 then m.proof || {left} || {right} else m.proof end as proof) "
            f"from {name}_up{k} m join {name}_runs{k} r on r.tree = m.tree and r.run = m.pos // 8)"
        )
    return ctes


def _op13() -> str:
    parts = lambda text: " || ".join(
        f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)
    )
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    digits = "list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i::bigint, 1))::bigint)"
    # CRC-32 bit by bit
    crc = (
        f"xor(4294967295, list_reduce(list_concat([4294967295::bigint], {digits}), lambda c, b: "
        "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))))"
    )
    ctes = [
        f"leaves as (select doc_id, lang, sha256({parts('text')}) as leaf, case when {crc} % 3 = 0 then sha256({parts(lowered)}) end as tampered from documents)",
        """placed as (
  select *, coalesce('=' || lang, '') as tree,
         row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n
  from leaves)""",
        *_levels(
            "t", "(select tree, pos, n, leaf as digest from placed)",
            "(select tree, pos, doc_id, leaf, coalesce(tampered, leaf) as acc, '' as proof from placed)", _TREE_LEVELS,
        ),
        f"""subroots as (
  select '' as tree, tree as of, digest, row_number() over (order by encode(tree)) - 1 as pos, count(*) over () as n from t{_TREE_LEVELS})""",
        *_levels(
            "s", "subroots",
            f"(select s.tree, s.pos, m.doc_id, m.leaf, s.digest as subroot, m.acc, m.proof from t_up{_TREE_LEVELS} m join subroots s on s.of = m.tree)", _TOP_LEVELS,
        ),
    ]
    return f"""with {", ".join(ctes)}
select m.doc_id, m.leaf, m.subroot, r.digest as root, sha256(m.proof) as proof_sha256, m.acc as folded_root, m.acc = r.digest as verified
from s_up{_TOP_LEVELS} m, s{_TOP_LEVELS} r"""


ORACLE: dict[str, str] = {
    "op2_minhash_near_dedup": _OP2,
    "op4_source_mixing": _OP4,
    "op5_embedding_near_dedup": _OP5,
    "op6_exact_top_k": _OP6,
    "op7_warc": _OP7,
    "op11_hard_negatives": _OP11,
    "op13_merkle_manifest": _op13(),
}
