"""Active holders from states that are kept between runs and adjusted by each new part of the card log.

One table holds three kinds of rows: cards' states, which are merged by their minimum; sums of deltas per holder,
issuer and quarter; and sums of starts and ends of holders' activity per issuer and quarter. A new part of the
log changes the states of some cards. What these cards had added is taken back and what they add now is put in,
first to the sums of deltas and then, for the holders concerned, to the starts and ends. All of it is appended in
one step, so a run that fails changes nothing, and a part of the log that comes again, or late, adds nothing twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cards
from ..operators.joins import key_filter, perhaps_in
from ..sources.storage import stored, temporary
from ..sources.tables import append_table, current_version

CARD, ACTIVITY, STEP = "card", "activity", "step"
_STATE = ("_first", *(f"_{t}" for t in cards.EVENT_TYPES))
_ACTIVITY = ("issuingHolderId", "subIssuerTaxId", "quarter")
_STEP = ("subIssuerTaxId", "quarter")


def _sums(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("amount").alias("amount"), F.sum("rows").alias("rows"))


def _signed(old: DataFrame, new: DataFrame, amount: str, keys: tuple[str, ...]) -> DataFrame:
    """Sums of what is new less what is old, and of the numbers of rows; without sums that change nothing."""
    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, (sign * F.col(amount)).cast("bigint").alias("amount"), F.lit(sign).cast("bigint").alias("rows"))

    return _sums(side(new, 1).unionByName(side(old, -1)), keys).filter("amount <> 0 OR rows <> 0")


def _key(*columns: str) -> Column:
    """Null is a key too."""
    return F.struct(*columns)


class CardStore:
    """States of the cards, holders and issuers of a card log in the table ``name``.

    ``end`` is the last day on which expirations count. It is part of what is stored: another day
    needs another table. An earliest log row is one by ``created``.
    """

    def __init__(self, spark: SparkSession, name: str, end: dt.date):
        self.spark, self.name, self.end = spark, name, end

    def _rows(self, kind: str, *columns: str) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("kind") == kind).select(*columns)

    def _merged(self, table: DataFrame) -> DataFrame:
        """The same states in the fewest rows."""
        rows = lambda kind: table.filter(F.col("kind") == kind)
        states = cards.merged_card_states(rows(CARD).select("issuingCardId", *_STATE))
        sums = [(k, _sums(rows(k), keys).filter("rows > 0")) for k, keys in ((ACTIVITY, _ACTIVITY), (STEP, _STEP))]
        parts = [states.withColumn("kind", F.lit(CARD)), *[df.withColumn("kind", F.lit(k)) for k, df in sums]]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part, allowMissingColumns=True)
        return whole.select(*table.columns)

    def activity(self) -> DataFrame:
        """``holder_activity`` of the whole log so far."""
        sums = _sums(self._rows(ACTIVITY, *_ACTIVITY, "amount", "rows"), _ACTIVITY).filter("rows > 0")
        return sums.select(*_ACTIVITY, F.col("amount").alias("delta"))

    def steps(self) -> DataFrame:
        return _sums(self._rows(STEP, *_STEP, "amount", "rows"), _STEP).filter("rows > 0").select(*_STEP, F.col("amount").alias("step"))

    def report(self, sub_issuers: DataFrame, zero_when_empty: bool = False) -> DataFrame:
        """``active_holders_report`` of the whole log so far."""
        return cards.report_of(cards.counts_of(stored(self.steps())), sub_issuers, zero_when_empty)

    def _deltas(self, states: DataFrame) -> DataFrame:
        return cards.activity_delta(cards.events_of(states, self.end))

    def _changed(self, log: DataFrame) -> DataFrame:
        """Cards whose state the log changes: ``issuingCardId``, ``old`` (null for a new card) and ``new``."""
        part = stored(cards.card_states(log).select(_key("issuingCardId").alias("key"), F.struct(*_STATE).alias("part")))
        if current_version(self.spark, self.name) is None:
            return part.select("key.issuingCardId", F.lit(None).cast(part.schema["part"].dataType).alias("old"), F.col("part").alias("new"))
        known = self._rows(CARD, "issuingCardId", *_STATE).withColumn("key", _key("issuingCardId"))
        wanted = cards.merged_card_states(perhaps_in(known, "key", key_filter(part, "key")).drop("key"))
        both = part.join(wanted.select(_key("issuingCardId").alias("key"), F.struct(*_STATE).alias("old")), "key", "left")
        least = [F.least(F.col(f"old.{c}"), F.col(f"part.{c}")).alias(c) for c in _STATE]
        changed = both.withColumn("new", F.struct(*least)).filter(~F.col("new").eqNullSafe(F.col("old")))
        return changed.select("key.issuingCardId", "old", "new")

    def update(self, log: DataFrame) -> None:
        """Takes in new rows of the card log, in any order; rows that came before change nothing."""
        version = current_version(self.spark, self.name)
        with temporary(self.spark):
            changed = stored(self._changed(log))
            if version is not None and changed.isEmpty():
                return
            before = changed.filter("old IS NOT NULL").select("issuingCardId", "old.*")
            after = changed.select("issuingCardId", "new.*")
            adjust = stored(_signed(self._deltas(before), self._deltas(after), "delta", _ACTIVITY))
            theirs = adjust.filter("false").select(*_ACTIVITY, "amount", "rows")
            if version is not None:  # a few holders more than those concerned: what they add is what is taken back
                known = self._rows(ACTIVITY, *_ACTIVITY, "amount", "rows").withColumn("holder", _key("issuingHolderId"))
                concerned = key_filter(adjust.select(_key("issuingHolderId").alias("holder")), "holder")
                theirs = stored(perhaps_in(known, "holder", concerned).drop("holder"))
            steps = _signed(self._steps_of(theirs), self._steps_of(theirs.unionByName(adjust)), "step", _STEP)
            rows = after.withColumn("kind", F.lit(CARD)).unionByName(
                adjust.withColumn("kind", F.lit(ACTIVITY)), allowMissingColumns=True).unionByName(
                steps.withColumn("kind", F.lit(STEP)), allowMissingColumns=True)
            append_table(rows, self.name, self._merged, "kind", version.number if version else None, rebalanced=False)

    def _steps_of(self, activity: DataFrame) -> DataFrame:
        by_holder = activity.repartition("issuingHolderId")  # the one shuffle of the sums and the running sums
        sums = _sums(by_holder, _ACTIVITY).filter("rows > 0").select(*_ACTIVITY, F.col("amount").alias("delta"))
        return cards.holder_steps(cards.holder_balance(sums))
