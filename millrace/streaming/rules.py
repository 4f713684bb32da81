"""Many rules in force at once, set, replaced and removed while the data flows."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

from millrace.operators.ordered import JSON_FORMATS
from millrace.streaming.keyed import Keyed, _sortable

#: Copies of the rules, each beside a part of the data.
SPREAD = 16


class Ruled(Keyed):
    """Rules by id, with the position that set them; a removed one stays as its position."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rules = handle.getMapState("rules", "id string", "place string, subject string, payload string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known: dict[str, tuple] = {}
        by_subject: dict[str | None, dict[str, str]] = {}
        for (id,), (place, subject, payload) in self.rules.iterator():
            known[id] = ([tuple(p) for p in json.loads(place)], subject)
            if payload is not None:
                by_subject.setdefault(subject, {})[id] = payload
        changed: dict[str, tuple] = {}
        # At one position a rule comes before the data.
        for row in sorted(rows, key=lambda r: (self.place(r), not r.is_rule)):
            if not row.is_rule:
                for subject in {row.subject, None}:
                    for id, payload in by_subject.get(subject, {}).items():
                        yield self.result(row.row, id, payload)
                continue
            place, id = self.place(row), row.id
            old = known.get(id)
            if old is not None and place <= old[0]:
                continue
            if old is not None:
                by_subject.get(old[1], {}).pop(id, None)
            payload = None if row.removed else row.row
            known[id] = (place, row.subject)
            if payload is not None:
                by_subject.setdefault(row.subject, {})[id] = payload
            changed[id] = (json.dumps(place), row.subject, payload)
        for id, value in changed.items():
            self.rules.updateValue((id,), value)


def rules_stream(
    stream: DataFrame,
    is_rule: Column,
    order: Sequence[str],
    rule_id: str,
    payload: Sequence[str],
    *,
    removed: Column,
    subject: tuple[Column, Column] | None = None,
    spread: int = SPREAD,
) -> DataFrame:
    """Every data row once for each rule in force at its place, with the rule's id and ``payload``.

    ``stream`` holds data and rule rows; a row whose flag is null is data. A rule row sets the
    rule of its id, in place of an earlier version, or takes it away where ``removed`` holds; a
    version that comes after a newer one is passed over. ``subject`` gives what a data row is
    about and what a rule is for: a rule is for equal rows only, one without a subject for all.

    The data are dealt to ``spread`` keys, whatever their own, and each of these has all rules:
    so no key is hot, and the state is ``spread`` times the rules, read once per micro-batch.
    """
    flag = F.coalesce(is_rule, F.lit(False))
    about, meant = subject or (F.lit(None), F.lit(None))
    data = [c for c in stream.columns if c not in (rule_id, *payload)]
    text = [F.to_json(F.struct(*names), JSON_FORMATS) for names in (payload, data)]
    dealt = F.array(F.pmod(F.xxhash64(*order), F.lit(spread)).cast("int"))
    everywhere = F.array(*[F.lit(i) for i in range(spread)])
    columns = [_sortable(stream, c).alias(f"o{i}") for i, c in enumerate(order)]
    rows = stream.select(
        F.explode(F.when(flag, everywhere).otherwise(dealt)).alias("k"),
        F.when(flag, text[0]).otherwise(text[1]).alias("row"), *columns, flag.alias("is_rule"),
        F.col(rule_id).cast("string").alias("id"), F.coalesce(removed, F.lit(False)).alias("removed"),
        F.when(flag, meant.cast("string")).otherwise(about.cast("string")).alias("subject"),
    )
    processor = Ruled()
    processor.places = [f"o{i}" for i in range(len(order))]
    processor.names = ["row", "id", "payload"]
    found = rows.groupBy("k").transformWithState(processor, "row string, id string, payload string", "append", "none")
    kind = stream.schema[rule_id].dataType
    parsed = [
        F.from_json("row", stream.select(*data).schema, JSON_FORMATS).alias("row"),
        F.col("id").cast(kind).alias(rule_id),
        F.from_json("payload", stream.select(*payload).schema, JSON_FORMATS).alias("payload"),
    ]
    return found.select(*parsed).select("row.*", rule_id, "payload.*")
