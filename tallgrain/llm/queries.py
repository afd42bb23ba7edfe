"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from . import bpe, chat, collocations, language, licenses, mixing, packing, quality, rules, simhash, spelling, suffix, topk
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}



def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


def rank_file() -> tuple[str, str]:
    """(path of the rank file, pattern that splits the text)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learnt from the labels outside the held-out third."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op2_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and of decoded bytes of every text."""
    return bpe.digests(table(spark, sf_dir, "documents"), *rank_file())


#: Target weights of the mix; sources count alike.
DOMAINS = {"web": 0.45, "news": 0.2, "books": 0.2, "reference": 0.15}
LANGS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}


def tree() -> dict:
    """Domain, language and source of a document, with their weights."""
    number = F.regexp_extract("source", r"(\d+)$", 1).try_cast("int")
    names = F.array(*map(F.lit, DOMAINS))
    domain = F.coalesce(F.get(names, F.pmod(number, F.lit(len(DOMAINS)))), F.lit("web"))
    return {"domain": (domain, DOMAINS), "lang": (F.col("lang"), LANGS), "source": (F.col("source"), {})}


def _mix_sql() -> str:
    """The mix in SQL, level by level."""
    def cases(column: str, weights: dict) -> str:
        listed = " ".join(f"when {column} = '{k}' then {v}::double" for k, v in weights.items())
        return f"case when false then 0::double {listed} else 1::double end"

    names = ", ".join(f"'{d}'" for d in DOMAINS)
    sql = f"""
    with docs as (
        select doc_id, coalesce(lang, '') as l, coalesce(source, '') as s,
            coalesce(list_extract([{names}], (try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % {len(DOMAINS)}) + 1), 'web') as d,
            len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as tokens, text
        from documents
    ), leaves as (
        select d, l, s, sum(tokens)::double as tokens, sum(tokens)::double * 2 as room from docs group by all
    ), total as (select sum(tokens) as budget from leaves),
    """
    above, names = "total", []
    for level, column, weights in (("a", "d", DOMAINS), ("b", "l", LANGS), ("c", "s", {})):
        names.append(column)
        keys, parent = ", ".join(names), ", ".join(names[:-1])
        by = f"partition by {parent}" if parent else ""
        join = f"join {above} using ({parent})" if parent else f", {above}"
        sql += f"""
    {level}0 as (select {keys}, sum(room) as room, {cases(column, weights)} as w from leaves where room > 0 group by {keys}),
    {level}1 as (
        select *, (budget - coalesce(sum(room) over ({by} order by room / w, {keys} rows between unbounded preceding and 1 preceding), 0))
            / sum(w) over ({by} order by room / w, {keys} rows between current row and unbounded following) as rate
        from {level}0 {join}
    ), {level} as (
        select {keys}, greatest(0, least(room, w * max(rate) over ({by}))) as budget from {level}1
    ),"""
        above = level
    return sql + """
    cut as (
        select leaves.d, leaves.l, leaves.s, leaves.tokens, coalesce(budget, 0) as budget,
            case when leaves.tokens > 0 then floor(coalesce(budget, 0) / leaves.tokens) else 0 end::int as whole
        from leaves left join c using (d, l, s)
    ), ordered as (
        select docs.*, whole, budget - whole * cut.tokens as rest,
            coalesce(sum(docs.tokens) over (partition by d, l, s order by md5('17|' || (whole + 1) || '|' || doc_id), doc_id
                rows between unbounded preceding and 1 preceding), 0) as met
        from docs join cut using (d, l, s)
    )
    select doc_id, d as domain, l as lang, s as source, unnest(range(1, whole + case when met < rest then 2 else 1 end))::int as epoch
    from ordered
    """


@query("op3_mix_sources", _mix_sql())
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many words as there are, dealt to domains, languages and sources by weight."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    levels = tree()
    mixed = mixing.mix(docs, levels, budget_share=1.0, max_epochs=2, seed=17)
    return mixed.select(
        "doc_id",
        levels["domain"][0].alias("domain"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        "epoch",
    )


@query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learnt outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    return model.predict(docs.select("doc_id", "text")).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted"
    )


@query("op5_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and signatures of every text."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op6_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without bytes of 100-byte strings that stand earlier."""
    return suffix.digests(table(spark, sf_dir, "documents"))


@query("op7_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, and the verdict of rules learnt from the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = rules.fit_on_labels(docs, table(spark, sf_dir, "labels").withColumn("label", F.col("quality")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counted = rules.counts(docs).withColumn("base_failed", failed).withColumn("rule", learnt.rule())
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"),
        "rule",
    )


@query(
    "op8_exact_top_k",
    """
    with v as (
        select vec_id, [floor(256 * x::double) for x in embedding] as v
        from embeddings
        where vec_id is not null and embedding is not null
          and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    ), scored as (
        select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
        from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
    ), ranked as (
        select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored
    )
    select query_id, place::int as rank, vec_id, score from ranked where place <= 5
    """,
)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query("op9_simhash_dedup")
def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and the smallest document it is linked to."""
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query(
    "op10_chat_format",
    r"""
    with plus as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all
        select * from (values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
    ), escaped as (
        select *, replace(replace(replace(replace(replace(text, '\', '\b'), '<s>', '\s'), '[INST]', '\i'),
            '[/INST]', '\j'), '</s>', '\e') as inner_text from plus
    )
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
        coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
        (3 + sum(length(role) + length(inner_text) + 17))::bigint as formatted_chars
    from escaped group by conv_id
    """,
)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text and loss mask."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn int, role string, text string")
    made = chat.conversations(chat.thread(rows.unionByName(planted)))
    turns = made.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return turns.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op11_collocations")
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of two to four words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op12_mixture_packing")
def mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, in sequences that each mirror the sources' shares of all tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), F.col("source"))


@query("op13_spelling_variants")
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated long word with its commoner spelling, if one is an edit away."""
    return spelling.variants(table(spark, sf_dir, "documents"))
