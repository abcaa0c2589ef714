"""Registered queries of the operators, each over a whole given table, and SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm import (
    alignment,
    attribution,
    digests,
    linecrf,
    mixing,
    neighbours,
    packing,
    periods,
    pieces,
    recurrent,
    simhash,
    substrings,
    toolcalls,
)
from shopgrain.llm.common import held_out
from shopgrain.operators.lookup import lookup_join

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    """Register a function of (session, folder) under its own name."""
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def piece_model() -> bytes:
    """The public SentencePiece model the contract names."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def rank_file() -> tuple[bytes, str]:
    """The public byte-level vocabulary as ranks, and the pattern that goes with it."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def byte_tokenizer() -> bytes:
    """The public byte-level tokenizer's JSON."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        return file.read()


@query
def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors with links at a cosine of 0.95 or more."""
    return neighbours.near_duplicates(_table(spark, folder, "embeddings"), threshold=0.95)


ORACLES["op1_neighbours"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), groups AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least AS component_id, vec_id = least AS kept
FROM v JOIN groups g ON v.vec_id = g.a LEFT JOIN counts c ON v.vec_id = c.a
"""


@query
def op2_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    found = digests.fingerprints(_table(spark, folder, "documents"))
    text = lambda name: F.translate(F.base64(name), "\r\n", "").alias(name)
    return found.select(
        "doc_id", "n_chars", "edited_sha256", text("fingerprint"), text("edited_fingerprint"),
        "near_edited", "near_next",
    )


@query
def op4_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs = _table(spark, folder, "documents")
    model = linecrf.trained(docs, _table(spark, folder, "labels"))
    return linecrf.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


ASK, SETUP = "ask", "setup"
TOOLS = {
    ASK: {
        "type": "object", "required": ["turn", "text"], "additionalProperties": False,
        "properties": {
            "turn": {"type": "integer", "minimum": 0},
            "text": {"type": "string", "minLength": 1, "maxLength": 400},
        },
    },
    SETUP: {
        "type": "object", "required": ["text"], "additionalProperties": False,
        "properties": {"text": {"type": "string"}},
    },
}


@query
def op5_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as calls: what a user or the system says calls, the assistant's turn right
    after is the result, and a call waits for the one two turns before."""
    turns = _table(spark, folder, "conversations")

    def name(turn):
        return F.concat_ws("-", F.lit("call"), F.col("conv_id"), turn)

    said = turns.where(~F.col("role").eqNullSafe("assistant"))
    calls = said.select(
        "conv_id", name(F.col("turn")).alias("id"), F.col("turn").alias("seq"),
        F.when(F.col("role") == "user", ASK).otherwise(SETUP).alias("name"),
        F.when(F.col("role") == "user", F.to_json(F.struct("turn", "text"))).otherwise(
            F.to_json(F.struct("text"))
        ).alias("arguments"),
        F.when(F.col("turn") >= 2, name(F.col("turn") - 2)).alias("waits_for"),
    )
    results = turns.where(F.col("role") == "assistant").select(
        "conv_id", name(F.col("turn") - 1).alias("id"), F.col("turn").alias("seq"),
        F.col("text").alias("content"),
    )
    linked = toolcalls.link(calls, results, TOOLS, conversation="conv_id", unlinked=True)
    return linked.withColumn("errors", F.array_join("errors", "; "))


# Depth is a call's place in its stretch of calls two turns apart. What a turn says is taken for
# text also where it would parse as JSON.
ORACLES["op5_tool_calls"] = f"""
    with calls as (
        select *, 'call-' || conv_id || '-' || turn as id,
            row_number() over (partition by conv_id, turn order by role = 'user' desc, text) as n,
            count(*) over (partition by conv_id, turn) as n_calls
        from conversations where role is distinct from 'assistant'
    ), firsts as (
        select *, lag(turn) over (partition by conv_id, turn % 2 order by turn) as before
        from calls where n = 1
    ), stretches as (
        select *, sum(case when before = turn - 2 then 0 else 1 end)
            over (partition by conv_id, turn % 2 order by turn) as stretch
        from firsts
    ), placed as (
        select *, row_number() over (partition by conv_id, turn % 2, stretch order by turn) - 1 as depth
        from stretches
    ), results as (
        select *, 'call-' || conv_id || '-' || (turn - 1) as id,
            row_number() over (partition by conv_id, turn order by text) as n,
            count(*) over (partition by conv_id, turn) as n_results
        from conversations where role = 'assistant'
    ), found as (
        select c.id, c.conv_id, c.turn, c.role, c.text, p.depth, case when c.n = 1 then c.n_calls else 0 end as n_calls,
            case when c.n = 1 then coalesce(r.n_results, 0) else 0 end as n_results,
            case when c.n = 1 then r.text end as result,
            case when c.n > 1 then 'duplicate'
                 when c.turn >= 2 and p.depth = 0 then 'dangling' end as kind
        from calls c
        left join placed p on p.id = c.id and p.conv_id = c.conv_id and c.n = 1
        left join results r on r.id = c.id and r.conv_id = c.conv_id and r.n = 1 and c.n = 1
    ), named as (
        select *, role is not distinct from 'user' as asks,
            case when role is not distinct from 'user' then '{ASK}' else '{SETUP}' end as name
        from found
    ), checked as (
        select *,
            case when text is null then '$.text: missing'
                 when asks and length(text) < 1 then '$.text: shorter than minLength'
                 when asks and length(text) > 400 then '$.text: longer than maxLength'
                 else '' end as errors,
            '{{"arguments":{{' || concat_ws(',', '"text":' || cast(to_json(text) as varchar),
                case when asks then '"turn":' || turn end)
            || '}},"id":' || cast(to_json(id) as varchar) || ',"name":"' || name || '","result":'
            || coalesce(cast(to_json(result) as varchar), 'null') || '}}' as json
        from named
    )
    select id, conv_id, turn as seq, name, depth, n_calls, n_results, errors,
        coalesce(kind, case when errors <> '' then 'invalid' when n_results = 0 then 'open'
                       else 'linked' end) as status, json
    from checked
    union all
    select r.id, r.conv_id, r.turn, null, null, 0, 0, '',
        case when c.id is null then 'unmatched result' else 'repeated result' end,
        '{{"arguments":null,"id":' || cast(to_json(r.id) as varchar) || ',"name":null,"result":'
        || coalesce(cast(to_json(r.text) as varchar), 'null') || '}}'
    from results r left join firsts c on c.id = r.id and c.conv_id = r.conv_id
    where c.id is null or r.n > 1
"""


@query
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document, encoded once as a whole."""
    ranks, pattern = rank_file()
    return attribution.token_counts(
        _table(spark, folder, "documents"), ranks, pattern, rule="most"
    )


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = _table(spark, folder, "documents")
    model = recurrent.trained(docs, _table(spark, folder, "labels"))
    return recurrent.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op10_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that repeated strings of 100 bytes cover."""
    found = substrings.without_repeats(_table(spark, folder, "documents"), width=100)
    return found.select(
        "doc_id", "n_bytes",
        F.aggregate(
            "spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]
        ).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLES["op10_substrings"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (
    SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM d WHERE length(h) >= 200
),
strings AS (SELECT doc_id, p, md5(substring(h, 2 * p + 1, 200)) AS w FROM places),
firsts AS (SELECT w, min((doc_id, p)) AS f FROM strings GROUP BY w HAVING count(*) > 1),
covered AS (SELECT doc_id, p FROM strings JOIN firsts USING (w) WHERE (doc_id, p) <> f),
marked AS (
    SELECT doc_id, p, CASE WHEN p > lag(p) OVER o + 100 THEN 1 ELSE 0 END AS fresh
    FROM covered WINDOW o AS (PARTITION BY doc_id ORDER BY p)
),
numbered AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM marked),
spans AS (
    SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, g
),
gaps AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before
    FROM spans
),
kept AS (
    SELECT doc_id, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS k,
        max(b) AS last, sum(b - a) AS n_removed, count(*) AS n_spans
    FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(k || substring(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash of 3-word shingles; groups at 2 bits or less."""
    found = simhash.near_duplicates(_table(spark, folder, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@query
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3 by source, at most 3 times each."""
    documents, sources = mixing.mix(_table(spark, folder, "documents"), cycle=(1, 2, 3), epochs=3)
    key = mixing.source_key(F.col("source")).alias("_key")
    return lookup_join(
        documents.select("*", key), sources.select(key, "source_size", "target"), ["_key"]
    ).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded."""
    return pieces.encode(
        _table(spark, folder, "documents"), piece_model(), with_ids=False, digests=True
    )


@query
def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in windows of 1024 tokens, each with the sources' shares of the corpus."""
    return packing.pack(_table(spark, folder, "documents"), byte_tokenizer(), size=1024, end_id=0)


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents, by crc32 of the id, the words from some place
    on repeat those at its front."""
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cut = docs.select("doc_id", "text", code.alias("h"), F.when(
        code % 10 == 0, words
    ).alias("w")).withColumn("g", F.expr("h div 10")).withColumn("n", F.expr("size(w)"))
    placed = cut.withColumn("a", F.expr("if(n > 0, g % n, 0L)")).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)")
    )
    repeated = F.expr(
        "array_join(transform(w, (x, i) -> if(i < a, x, w[cast(a + (i - a) % p as int)])), ' ')"
    )
    return placed.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(
        F.col("text")
    ).alias("text"))


@query
def op12_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document."""
    return periods.periodic_runs(
        with_repeats(_table(spark, folder, "documents")), least_length=6, least_periods=4
    ).drop("n_words")


ORACLES["op12_periods"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_reduce(
            [4294967295] || list_transform(
                string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
            lambda c, b: list_reduce(
                [xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)
        ) AS c
    FROM documents
),
e AS (
    SELECT doc_id, w, len(w) AS n, xor(c, 4294967295) AS h, xor(c, 4294967295) // 10 AS g FROM d
),
cut AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM e),
placed AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
numbered AS (SELECT doc_id, n, w, a, p, unnest(range(n)) AS i FROM placed),
words AS (
    SELECT doc_id, n, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS word
    FROM numbered
),
pairs AS (
    SELECT s.doc_id, s.i, t.i - s.i AS q FROM words s
    JOIN words t ON s.doc_id = t.doc_id AND s.word = t.word AND t.i > s.i
    WHERE 4 * (t.i - s.i) <= s.n
),
islands AS (
    SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island
    FROM pairs
),
stretches AS (
    SELECT doc_id, min(i) AS start, count(*) + q AS length, q AS period
    FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
),
runs AS (
    SELECT * FROM stretches r WHERE NOT EXISTS (
        SELECT 1 FROM stretches o WHERE o.doc_id = r.doc_id AND o.period < r.period
        AND o.start <= r.start AND o.start + o.length >= r.start + r.length)
),
listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(
        start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
        first({'s': start, 'n': length, 'q': period}
            ORDER BY length / period DESC, start, period) AS best
    FROM runs GROUP BY doc_id
),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words w WHERE NOT EXISTS (
        SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.period
        AND w.i < r.start + r.length)
    GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start,
    best.n::BIGINT AS length, best.q::BIGINT AS period,
    (1000 * best.n // best.q)::BIGINT AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens by two tokenizers, linked where they end together."""
    documents, _ = alignment.align(
        _table(spark, folder, "documents"), byte_tokenizer(), piece_model()
    )
    return documents
