"""The registered queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bpe, centroids, chat, counts, exact, graph, importance, packing, phrases, repeats, simhash, toxicity, urls
from riskloom.session import prepare

QUERIES = {}
SQL: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = lambda spark, folder: fn(prepare(spark), folder)
    return fn


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@register
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    labels = read(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@register
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.groups(read(spark, folder, "documents"), keep="largest")


SQL["op2_exact_dedup"] = """
with t as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as n
  from documents),
g as (select n, max(doc_id) as keep_id, count(*) as group_size from t group by n)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.n) as text_sha256
from t join g on t.n = g.n"""


@register
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(read(spark, folder, "documents"), ranks, public_tokenizers.PATTERN, keep=["doc_id"])


@register
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


@register
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register
def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, folder, "documents"))


@register
def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    given = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    one = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(hard).alias("text")) for i, r in enumerate(("user", "assistant"))
    ])).alias("t")).select("conv_id", "t.*")
    made = chat.format_chats(given.unionByName(one))
    back = made.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_runs")).alias("loss"),
    )
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


SQL["op7_chat_format"] = """
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
m as (
  select *, coalesce(lag(role) over (partition by conv_id order by turn nulls first, role, text) = role, false) as joined from t),
e as (
  select *, length(replace(replace(text, '\\', '\\b'), '<', '\\l')) + case when joined then 6 else length(role) + 15 end as chars from m)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars) as bigint) as formatted_chars
from e group by conv_id"""


@register
def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return graph.nearest(read(spark, folder, "embeddings"))


@register
def op6_importance(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    good = read(spark, folder, "labels").where((F.col("quality") == 1) & ~toxicity.held_out())
    return importance.resample(docs, good, 0.5, power=0.5)


@register
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts before and after every run of three and more digits is masked."""
    docs = counts.masking_edits(read(spark, folder, "documents").select("doc_id", "text"), r"\d{3,}", "000")
    made = counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, "edits")
    return made.select("doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_encoded", F.sha2("edited", 256).alias("edited_sha256"))


@register
def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(read(spark, folder, "embeddings"))


@register
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    made = phrases.collocations(read(spark, folder, "documents"))
    return made.withColumn("rank", F.col("rank").cast("long"))


SQL["op12_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
lists as (
  select lang, row_number() over () as piece, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') as w from pieces),
total as (select lang, cast(sum(len(w)) as bigint) as n from lists group by lang),
words as (select lang, piece, unnest(w) as w1, generate_subscripts(w, 1) as pos from lists),
follow as (
  select lang, w1, lead(w1, 1) over s as w2, lead(w1, 2) over s as w3 from words window s as (partition by piece order by pos)),
grams as (
  select lang, 1 as k, w1 as phrase from follow
  union all select lang, 2, w1 || ' ' || w2 from follow where w2 is not null
  union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from follow where w3 is not null),
f as (select lang, k, phrase, count(*) as a from grams group by lang, k, phrase having count(*) >= 10),
parts as (select *, string_split(phrase, ' ') as w from f where k > 1),
cuts as (
  select lang, phrase, a, 1 as cut, w[1] as lp, array_to_string(w[2:], ' ') as rp from parts
  union all select lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] from parts where k = 3),
scored as (
  select c.lang, c.phrase, c.a, c.cut, fl.a as l, fr.a as r,
         cast((1000000::hugeint * c.a * c.a) // (fl.a::hugeint * fr.a) as bigint) as score
  from cuts c join f fl on fl.lang = c.lang and fl.phrase = c.lp and fl.k < 3
  join f fr on fr.lang = c.lang and fr.phrase = c.rp and fr.k < 3),
low as (select *, row_number() over (partition by lang, phrase order by score, cut) as i from scored),
held as (
  select lang, phrase, max(a) as over from (
    select lang, w[1] || ' ' || w[2] as phrase, a from parts where k = 3
    union all select lang, w[2] || ' ' || w[3], a from parts where k = 3) group by lang, phrase),
kept as (
  select l.* from low l left join held h on h.lang = l.lang and h.phrase = l.phrase
  where l.i = 1 and (h.over is null or 100 * h.over < 50 * l.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
from ranked r join total t on t.lang = r.lang where r.rank <= 2000"""

# The rules of the query.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@register
def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(read(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


SQL["op13_url_filter"] = r"""
with s as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
u as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from s),
v as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule from u)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict from v"""
