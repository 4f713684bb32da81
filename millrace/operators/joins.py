"""Windowed joins, lookups, and rules that change while data flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.mergeable import latest
from millrace.functions.messages import INTERCEPTED, INTERCEPTED_FOR
from millrace.functions.times import with_window
from millrace.operators.late import LATE, ON_TIME
from millrace.operators.ordered import Ordered

RIGHT_MISSING = -999


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    right_columns: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Rows of both sides with equal keys in the same time window.

    ``right_columns`` maps columns of the right side to their names in the result. The
    join is left to Spark: small sides are broadcast by their measured size, and skewed
    partitions are split at run time.
    """
    left = with_window(left, ts, size).drop("window_end")
    right = with_window(right, ts, size).select(
        *keys, "window_start", *[F.col(c).alias(n) for c, n in right_columns.items()]
    )
    return left.join(right, [*keys, "window_start"], how)


def join_any_key(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """A join in which a null key is a key like any other, as it is for grouping."""
    names = {k: f"__of_{k}" for k in keys}
    condition = F.lit(True)
    for key, name in names.items():
        condition = condition & F.col(key).eqNullSafe(F.col(name))
    return left.join(right.withColumnsRenamed(names), condition, how).drop(*names.values())


def filled(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Columns of a lookup table, one row per key there; defaults where nothing is found."""
    return filled(df.join(table.select(*on, *defaults), list(on), "left"), defaults)


def keep_matching(df: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows for which the lookup table has a row."""
    return df.join(table.select(*on), list(on), "left_semi")


#: Words of 64 bits in a key filter, which is what it sends to every task: 2 MB of bits.
FILTER_WORDS = 1 << 18


def key_filter(table: DataFrame, on: Sequence[str], words: int = FILTER_WORDS) -> DataFrame:
    """Bits of a table's keys: at most ``words`` rows (word, bits), however many keys there are.

    A key sets three bits of one word. Null keys, which match nothing, set none.
    """
    word, mask = _bits(on, words)
    keys = table.select(*on).dropna()
    return keys.select(word.alias("__word"), mask.alias("__mask")).groupBy("__word").agg(F.bit_or("__mask").alias("__bits"))


def _bits(on: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word of a key and the bits that it sets there."""
    first, second = F.xxhash64(*on), F.xxhash64(F.lit(7), *on)
    mask = F.lit(0).cast("bigint")
    for part in range(3):
        at = F.shiftright(second, 6 * part).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
    return F.pmod(first, F.lit(words)), mask


def _marked(df: DataFrame, bits: DataFrame, on: Sequence[str], words: int) -> DataFrame:
    """Rows with ``__hit``, whether their key may be in the filter."""
    word, mask = _bits(on, words)
    rows = df.withColumns({"__word": word, "__mask": mask})
    joined = rows.join(F.broadcast(bits), "__word", "left")
    known = F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask")
    for key in on:
        known = known & F.col(key).isNotNull()
    return joined.withColumn("__hit", F.coalesce(known, F.lit(False))).drop("__word", "__mask", "__bits")


def possible(df: DataFrame, table: DataFrame, on: Sequence[str], words: int = FILTER_WORDS) -> DataFrame:
    """Rows whose key may be in ``table``: all that are, and a few others.

    A filter of the table's keys goes to every task, so rows without a partner are left out
    where they are read. With many more keys than ``words`` nearly all rows pass.
    """
    return _marked(df, key_filter(table, on, words), on, words).filter("__hit").drop("__hit")


def keep_matching_filtered(df: DataFrame, table: DataFrame, on: Sequence[str], words: int = FILTER_WORDS) -> DataFrame:
    """``keep_matching`` for a large lookup table that matches few rows: only those are shuffled."""
    return keep_matching(possible(df, table, on, words), table, on)


def lookup_filtered(
    df: DataFrame, table: DataFrame, on: Sequence[str], defaults: Mapping[str, object], words: int = FILTER_WORDS
) -> DataFrame:
    """``lookup`` for a large table that few rows are found in; the rest take the defaults unshuffled.

    The input is read twice, once for each part.
    """
    marked = _marked(df, key_filter(table, on, words), on, words)
    found = lookup(marked.filter("__hit").drop("__hit"), table, on, defaults)
    kinds = {c: found.schema[c].dataType for c in defaults}
    rest = marked.filter("NOT __hit").drop("__hit")
    return found.unionByName(rest.withColumns({c: F.lit(v).cast(kinds[c]) for c, v in defaults.items()}))


def on_time_join(classified: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join within the window in which late rows find no partner.

    ``classified`` comes from ``late.classify``. The status is one of the join keys, so
    that rows on time and late rows go through one join over one scan.
    """
    right = right.withColumn("status", F.lit(ON_TIME))
    return classified.join(right, [*keys, "window_start", "status"], "left")


def dimension_join(
    classified: DataFrame,
    dimension: DataFrame,
    table: DataFrame,
    key: str,
    value: str,
    on_time_miss: str = "drop",
    late_miss: str = "keep",
) -> DataFrame:
    """Join rows on time with the dimension rows of their window; resolve the rest by lookup.

    ``dimension`` has ``window_start``, the key and the value; ``table`` is the whole
    lookup table. A row that the lookup does not know either is left out (``drop``) or
    shows its key in place of the value (``keep``).
    """
    joined = on_time_join(classified, dimension.select("window_start", key, value), [key])
    known = table.select(key, F.col(value).alias("__found"))
    rows = joined.join(known, key, "left").withColumn(value, F.coalesce(value, "__found"))
    dropped = [s for s, miss in ((ON_TIME, on_time_miss), (LATE, late_miss)) if miss == "drop"]
    rows = rows.filter(F.col(value).isNotNull() | ~F.col("status").isin(dropped))
    return rows.withColumn(value, F.coalesce(value, F.col(key).cast("string"))).drop("__found")


def latest_rule(
    data: DataFrame,
    rules: DataFrame,
    order: Sequence[str],
    payload: Sequence[str],
) -> DataFrame:
    """Each data row with the payload of the last rule before it; null before the first.

    Rules are put among the data rows and carried along by an ordered scan, so that they
    may grow with the data.
    """
    order, payload = list(order), list(payload)
    kind = rules.select(F.struct(*payload).alias("s")).schema["s"].dataType
    # At equal order a rule comes first.
    marked = data.withColumns({"__rule": F.lit(None).cast(kind), "__is_data": F.lit(1)})
    both = marked.unionByName(
        rules.select(*order, F.struct(*payload).alias("__rule"), F.lit(0).alias("__is_data")),
        allowMissingColumns=True,
    )
    scanned = Ordered.of(both, [], [*order, "__is_data"]).scan({"__in_force": latest("__rule")})
    found = scanned.result().filter(F.col("__is_data") == 1)
    found = found.withColumns({c: F.col(f"__in_force.{c}") for c in payload})
    return found.drop("__is_data", "__rule", "__in_force")


def switched(
    data: DataFrame,
    controls: DataFrame,
    order: Sequence[str],
    control: str,
    texts: Mapping[str, str],
    otherwise: str,
    name: str = "text",
) -> DataFrame:
    """Each data row with the text that the latest control value selects."""
    rows = latest_rule(data, controls, order, [control])
    text = F.lit(otherwise)
    for value, chosen in texts.items():
        text = F.when(F.col(control) == value, F.lit(chosen)).otherwise(text)
    return rows.withColumn(name, text).drop(control)


def intercepted(
    data: DataFrame, keywords: DataFrame, order: Sequence[str], text: str, initial: str
) -> DataFrame:
    """Data rows whose text contains the keyword in force, with a message naming it."""
    rows = latest_rule(data, keywords, order, ["keyword"])
    rows = rows.withColumn("keyword", F.coalesce("keyword", F.lit(initial)))
    message = F.concat(
        F.lit(INTERCEPTED), F.col(text), F.lit(INTERCEPTED_FOR), F.col("keyword")
    )
    return rows.filter(F.col(text).contains(F.col("keyword"))).withColumn("message", message)


def paired_actions(
    data: DataFrame, patterns: DataFrame, user: Sequence[str], order: Sequence[str], action: str
) -> DataFrame:
    """Data rows where the user's previous and current action are the pattern in force.

    ``patterns`` has ``first_action`` and ``second_action`` besides the order columns.
    """
    previous = Ordered.of(data, user, order).shift("__previous", F.col(action), backward=True)
    rows = latest_rule(previous.result(), patterns, order, ["first_action", "second_action"])
    return rows.filter(
        (F.col("__previous") == F.col("first_action")) & (F.col(action) == F.col("second_action"))
    ).drop("__previous")


def nested_answer(
    df: DataFrame, answers: DataFrame, on: Sequence[str], paths: Mapping[str, Column]
) -> DataFrame:
    """Fields of a nested JSON answer looked up by key, empty texts on any miss.

    ``answers`` holds one answer per key; ``paths`` are expressions over its columns.
    """
    # Fields are taken per answer, not per data row, and the text stays out of the join.
    fields = answers.select(*on, *[c.alias(n) for n, c in paths.items()])
    return filled(df.join(fields, list(on), "left"), dict.fromkeys(paths, ""))
