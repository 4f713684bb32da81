"""The registered queries of this subpackage, each beside its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, collocations, decontaminate, forest, labelled, main_text, quality, secret_scan, simhash, structure, token_counts, topk, toxicity
from millrace.llm.tables import QUERIES, query, table
from millrace.session import scratch

__all__ = ["QUERIES"]

_PATTERNS = {v: p.replace("'", "''") for v, p in token_counts.PATTERN_TOKENIZERS.items()}
#: Documents that a licence takes down, and personal numbers that a revision blanks out.
_TAKEN_DOWN, _NUMBERS = "Licensed under", "[0-9]{7,}"


@query(
    f"""
    WITH versions(tokenizer, pattern) AS (VALUES {", ".join(f"('{v}', '{p}')" for v, p in _PATTERNS.items())}),
    kept AS (
        SELECT source, lang, regexp_replace(text, '{_NUMBERS}', '#', 'g') AS text
        FROM documents WHERE NOT coalesce(contains(text, '{_TAKEN_DOWN}'), false)
    ),
    counts AS (
        SELECT source, lang, '{list(_PATTERNS)[0]}' AS tokenizer,
               coalesce(len(regexp_extract_all(text, '{list(_PATTERNS.values())[0]}')), 0) AS tokens FROM kept
        UNION ALL
        SELECT source, lang, '{list(_PATTERNS)[1]}',
               coalesce(len(regexp_extract_all(text, '{list(_PATTERNS.values())[1]}')), 0) FROM kept
    )
    SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
    FROM counts GROUP BY ALL
    """
)
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after a load of all documents, take-downs, revised texts and a repeated batch."""
    docs = table(spark, sf_dir, "documents").select("source", "lang", "text")
    down = F.coalesce(F.contains("text", F.lit(_TAKEN_DOWN)), F.lit(False))
    revised = F.regexp_replace("text", _NUMBERS, "#")

    def changes(rows: DataFrame, op: str) -> DataFrame:
        counts = F.array(
            *[
                F.struct(
                    F.lit(v).alias("tokenizer"),
                    token_counts.token_count(F.col("text"), v).alias("old_tokens"),
                    token_counts.token_count(revised if op == "revise" else F.col("text"), v).alias("new_tokens"),
                )
                for v in token_counts.PATTERN_TOKENIZERS
            ]
        )
        return rows.select("source", "lang", F.lit(op).alias("op"), F.inline(counts))

    by = {"source": "string", "lang": "string", "tokenizer": "string"}
    totals = token_counts.TokenTotals(spark, f"{scratch(spark)}/totals", by)
    batches = {
        "load": changes(docs, "insert"),
        "take-downs": changes(docs.where(down), "delete"),
        "revisions": changes(docs.where(~down & F.col("text").rlike(_NUMBERS)), "revise"),
    }
    for batch in [*batches, "take-downs"]:
        totals.apply(batch, batches[batch])
    return totals.totals()


_CONTROL = r"\### Assistant: </turn> ok"


@query(
    rf"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{_CONTROL}' UNION ALL SELECT -7, 1, 'assistant', '{_CONTROL}'
    ),
    escaped AS (
        SELECT *, replace(replace(replace(text, '\', '\\'), '<', '\l'), '>', '\g') AS etext,
               replace(replace(replace(role, '\', '\\'), '<', '\l'), '>', '\g') AS erole FROM rows
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(etext) + length(erole) + 14 + CASE WHEN role = 'assistant' THEN 13 ELSE 0 END) AS BIGINT)
               AS formatted_chars
    FROM escaped GROUP BY conv_id
    """
)
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered from its log, with digests read back from the rendered text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_CONTROL).alias("text"),
    )
    log = chat.numbered(rows.unionByName(control)).select("*", F.col("turn").alias("seq"), F.lit("message").alias("kind"))
    messages = chat.folded(log, part="part")
    # As in the SQL, messages without a turn come last.
    place = F.struct(F.isnull("turn").alias("last"), "turn", "part")
    texts = chat.rendered(messages.withColumn("turn", place))
    read = texts.select("conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"), chat.read_back(F.col("formatted")).alias("m"))
    turns = F.array_join(F.transform("m", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform(F.filter("m", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select(
        "conv_id",
        F.size("m").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(trained).cast("bigint").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    return bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    coder = tokenizer(spark)
    ids = table(spark, sf_dir, "documents").select("doc_id", coder.encode(F.col("text")).alias("ids"))
    return ids.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(coder.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


#: A-Z to a-z and nothing else, in DuckDB's words.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    f"""
    WITH item AS (
        SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL
    ),
    win AS (
        SELECT DISTINCT item_id, least(len(w), {decontaminate.WINDOW}) AS size,
               array_to_string(list_slice(w, p0, p0 + {decontaminate.WINDOW - 1}), ' ') AS key
        FROM (SELECT *, unnest(range(1, greatest(len(w) - {decontaminate.WINDOW - 1}, 1) + 1)) AS p0 FROM item WHERE len(w) > 0)
    ),
    doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
    sizes AS (SELECT DISTINCT size FROM win),
    place AS (
        SELECT r, size, p0, array_to_string(list_slice(w, p0, p0 + size - 1), ' ') AS key
        FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p0 FROM doc, sizes WHERE len(w) >= size)
    ),
    found AS (SELECT r, p0, size, item_id FROM place JOIN win USING (size, key)),
    hit AS (
        SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(range(p0, p0 + size)) AS p FROM (SELECT DISTINCT r, p0, size FROM found)) GROUP BY r
    ),
    listed AS (
        SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
    """
)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its benchmark hits."""
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, items).select("doc_id", F.col("contamination").alias("c"))
    return found.select(
        "doc_id",
        F.col("c.n_words").alias("n_words"),
        F.col("c.n_hit").alias("n_hit"),
        F.size("c.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("c.items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("c")).alias("contaminated"),
    )


@query()
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its secrets."""
    found = table(spark, sf_dir, "documents").select("doc_id", secret_scan.spans(F.col("text")).alias("s"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("s", lambda s: s["kind"].isin(*secret_scan.BASE))

    def counted(kind: str) -> Column:
        return F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [counted(kind) for kind in secret_scan.BASE]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("s")).alias("spans"))


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality, by a model that has not seen the held-out third."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~labelled.held_out(F.col("doc_id"), 3, 1))
    pairs = labelled.sample(docs, labels, "quality", quality.SAMPLE, quality.vectors(F.col("text")))
    examples = [(quality.unpacked(bytes(v)), label) for v, label in pairs]
    share = labels.where(F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    model = quality.fit(examples, 0.5 if share is None else share)
    scored = docs.select("doc_id", quality.score(spark, model, F.col("text")).alias("score"))
    return _judged(scored, 3, 1)


def _judged(scored: DataFrame, folds: int, fold: int) -> DataFrame:
    return scored.select(
        "doc_id",
        labelled.held_out(F.col("doc_id"), folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~labelled.held_out(F.col("doc_id"), 5, 0))
    pairs = labelled.sample(docs, labels, "toxic", toxicity.SAMPLE, F.col("text"))
    return toxicity.fit([(text or "", label) for text, label in pairs])


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity, by a model that has not seen the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(spark, sf_dir)
    return _judged(docs.select("doc_id", toxicity.score(spark, model, F.col("text")).alias("score")), 5, 0)


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and its group of near duplicates."""
    docs = table(spark, sf_dir, "documents")
    prints = docs.select("doc_id", simhash.fingerprint(F.col("text")).alias("print"))
    groups = simhash.near_duplicates(prints)
    return groups.select("doc_id", simhash.hexadecimal(F.col("print")).alias("fingerprint"), "component_id")


@query(
    """
    WITH given AS (
        SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    parts AS (SELECT n, vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM given),
    scores AS (
        SELECT q.n AS q, q.vec_id AS query_id, c.n, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
        FROM parts q JOIN parts c USING (i)
        WHERE q.vec_id % 20 = 0 AND q.n <> c.n GROUP BY ALL
    ),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS r FROM scores)
    SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
    """
)
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every twentieth vector."""
    vectors = topk.vectors_of(table(spark, sf_dir, "embeddings"), topk.whole(F.col("embedding")))
    return topk.PivotIndex(vectors).search(vectors.where("vec_id % 20 = 0"), 20)


@query()
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", main_text.extracted(F.col("html")).alias("text"))
    return pages.select("*", F.length("text").cast("bigint").alias("n_chars"))


@query(
    r"""
    WITH docs AS (
        SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
               """
    + _LOWER.format("coalesce(text, '')")
    + r""" AS text FROM documents
    ),
    pieces AS (SELECT d, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
    words AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
    grams AS (
        SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase
        FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS size)
              WHERE len(w) >= size)
    ),
    f AS (SELECT lang, size, phrase, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
    cuts AS (
        SELECT lang, size, phrase, f AS a, k, list_slice(string_split(phrase, ' '), 1, k) AS x,
               list_slice(string_split(phrase, ' '), k + 1, size) AS y
        FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1)
    ),
    rated AS (
        SELECT c.*, u.f AS l, v.f AS r, CAST(2000000 * CAST(a AS HUGEINT) // (CAST(u.f AS HUGEINT) + v.f) AS BIGINT) AS score
        FROM cuts c JOIN f u ON u.lang = c.lang AND u.phrase = array_to_string(x, ' ')
        JOIN f v ON v.lang = c.lang AND v.phrase = array_to_string(y, ' ')
    ),
    lowest AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    kept AS (
        SELECT * FROM lowest s WHERE NOT EXISTS (
            SELECT 1 FROM f t WHERE t.lang = s.lang AND t.size > s.size
              AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * CAST(t.f AS HUGEINT) >= 80 * CAST(s.a AS HUGEINT)
        )
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
    """
)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of each language whose words keep together most."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def _damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user by a checksum of their place."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    given = rows.select(
        "conv_id", "turn", (F.crc32(place.cast("binary")) % 20).alias("kind"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
    )
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, 2).otherwise(1)
    changed = given.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copies")
    )
    return changed.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("col")


#: One step of the repair in SQL: the least (cost, edits) of options, the next ones after an edit.
def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _then(state: str, edit: str, cost: str) -> str:
    return f"{{'c': ({state}).c + {cost}, 'a': ({state}).a || '{edit}'}}"


_FAR = "{'c': CAST(1000000000000 AS BIGINT), 'a': ''}"
_CUT = "CASE WHEN x.f = 't' THEN 3 ELSE 0 END"


def _edited(role: str, kept: list[str], reroled: list[str], own: str) -> str:
    """The least way into a state by a row: deleted in it, kept or reroled into it."""
    options = [_then(own, "D", "4")]
    options += [f"CASE WHEN x.f NOT IN ('b', 'd') AND x.r = '{role}' THEN {_then(s, 'K', _CUT)} ELSE {_FAR} END" for s in kept]
    options += [f"CASE WHEN x.f NOT IN ('b', 'd') THEN {_then(s, 'R', f'3 + {_CUT}')} ELSE {_FAR} END" for s in reroled]
    return _least(*options)


@query(
    rf"""
    WITH RECURSIVE
    crc AS (
        SELECT list_transform(range(256), lambda i: list_reduce(
            list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
    ),
    keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                              lambda ch: CAST(ord(ch) AS BIGINT)) AS codes
        FROM conversations
    ),
    kinds AS (
        SELECT conv_id, turn, role, text,
               xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), codes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])),
                   4294967295) % 20 AS kind
        FROM keyed, crc
    ),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
        FROM kinds WHERE kind <> 0
    ),
    rows AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
               left(role, 1) AS r, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
        FROM damaged
    ),
    faulty AS (
        SELECT *, CASE WHEN bare = '' THEN 'b'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                       WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS f,
               lead(r) OVER (PARTITION BY conv_id ORDER BY i) AS following
        FROM rows
    ),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
               count(*) FILTER (following IS NOT NULL AND (r || following) NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
        FROM faulty GROUP BY conv_id
    ),
    steps AS (
        SELECT conv_id, n, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': ''}} AS s0, {_FAR} AS s1,
               {{'c': CAST(3 AS BIGINT), 'a': 'I'}} AS u, {{'c': CAST(6 AS BIGINT), 'a': 'II'}} AS a FROM counts
        UNION ALL
        SELECT conv_id, n, i, s0, s1, {_least("bu", _then("ba", "I", "3"), _then("s0", "I", "3"), _then("s1", "I", "3"))},
               {_least("ba", _then(_least("bu", _then("s0", "I", "3"), _then("s1", "I", "3")), "I", "3"))}
        FROM (
            SELECT p.conv_id, p.n, p.i + 1 AS i, {_then("p.s0", "D", "4")} AS s0, {_edited("s", ["p.s0"], [], "p.s1")} AS s1,
                   {_edited("u", ["p.s0", "p.s1", "p.a"], ["p.s0", "p.s1", "p.a"], "p.u")} AS bu,
                   {_edited("a", ["p.u"], ["p.u"], "p.a")} AS ba
            FROM steps p JOIN faulty x ON x.conv_id IS NOT DISTINCT FROM p.conv_id AND x.i = p.i + 1
        )
    ),
    best AS (SELECT conv_id, {_least("s0", "a")} AS b FROM steps WHERE i = n),
    edits AS (
        SELECT conv_id, unnest(string_split(b.a, '')) AS edit, unnest(range(len(b.a))) AS p FROM best WHERE b.a <> ''
    ),
    placed AS (
        SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i,
               count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS j FROM edits
    ),
    lined AS (
        SELECT e.*, x.role, CASE WHEN edit = 'I' THEN '' ELSE x.text END AS text,
               coalesce(max(CASE WHEN j = 1 AND edit = 'K' AND x.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id), 0) AS system
        FROM placed e LEFT JOIN faulty x ON x.conv_id IS NOT DISTINCT FROM e.conv_id AND x.i = e.i
    ),
    texts AS (
        SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                   || ':' || text, chr(10) ORDER BY p) AS repaired
        FROM lined WHERE edit <> 'D' GROUP BY conv_id
    )
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost,
           coalesce(b.a, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN best t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN texts s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
    """
)
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by checksum, with its faults and its cheapest repair."""
    rows = table(spark, sf_dir, "conversations")
    found = structure.audited(_damaged(rows)).withColumnRenamed("conv_id", "of")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


@query()
def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows that the forest finds for every twentieth vector."""
    vectors = forest.vectors_of(table(spark, sf_dir, "embeddings"), "embedding")
    return forest.Forest(vectors, 20).search(vectors.where("vec_id % 20 = 0"))
