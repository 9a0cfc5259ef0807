"""Quality checks as violation frames (key, reason), and a wrapper that raises on them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from statspark.schemas import FACT, METRICS
from statspark.sources.tables import checkpoint_folder


class QualityError(ValueError):
    pass


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """A row per row and broken rule; an unknown outcome of a rule counts as broken."""
    reasons = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return rows.select(F.col(key).cast("string").alias("key"), F.explode(reasons).alias("reason"))


def at_least(rows: DataFrame, n: int) -> DataFrame:
    """One violation if there are fewer rows."""
    counted = rows.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < n)
    return counted.select(F.lit(None).cast("string").alias("key"), F.concat(F.lit(f"expected at least {n} rows, got "), F.col("n").cast("string")).alias("reason"))


def require(found: DataFrame, most: int = 5) -> None:
    """Raise with the first violations, if there are any."""
    if rows := found.limit(most).collect():
        raise QualityError("; ".join(f"{r['key']}: {r['reason']}" for r in rows))


@dataclass
class Gate:
    """Counts that Spark takes while rows are written anyway, and the decision on them.

    ``on`` marks the rows; once an action has run over them, ``found`` and ``require`` know the outcome, without another
    pass. The marked rows should be written without a shuffle behind the mark: then a task that runs again counts once.
    """

    rules: dict[str, Column]
    key: str
    least: int = 0
    observation: Observation = field(default_factory=Observation)

    def on(self, rows: DataFrame) -> DataFrame:
        counts = [F.count(F.lit(1)).alias("rows")]
        for i, ok in enumerate(self.rules.values()):
            broken = ~F.coalesce(ok, F.lit(False))
            counts += [F.count_if(broken).alias(f"broken_{i}"), F.min(F.when(broken, F.col(self.key).cast("string"))).alias(f"first_{i}")]
        return rows.observe(self.observation, *counts)

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]

    def found(self) -> list[tuple[str, int, str | None]]:
        """Reason, rows that break the rule, and the smallest of their keys."""
        seen = self.observation.get
        return [(reason, seen[f"broken_{i}"], seen[f"first_{i}"]) for i, reason in enumerate(self.rules)]

    def require(self) -> None:
        if self.rows < self.least:
            raise QualityError(f"expected at least {self.least} rows, got {self.rows}")
        if broken := [f"{first}: {reason} ({n} rows)" for reason, n, first in self.found() if n]:
            raise QualityError("; ".join(broken))


def schedule_rules() -> dict[str, Column]:
    """Raw schedule games: names and date are there and the id is a positive number."""
    return {
        "missing home_name": F.col("home_name").isNotNull(),
        "missing away_name": F.col("away_name").isNotNull(),
        "missing game_date": F.col("game_date").isNotNull(),
        "invalid game_id": F.col("game_id").try_cast("long") > 0,
    }


def schedule_violations(games: DataFrame) -> DataFrame:
    return violations(games, "game_id", schedule_rules())


def transformed_rules() -> dict[str, Column]:
    """Game rows: positive id, plausible season, date written as YYYY-MM-DD."""
    date = F.col("game_date").cast("string")
    return {
        "invalid game_pk": F.col("game_pk") > 0,
        "invalid season": F.col("season").between(1870, 2100),
        "invalid game_date": (F.length(date) >= 10) & (F.substring(date, 5, 1) == "-") & (F.substring(date, 8, 1) == "-"),
    }


def transformed_violations(games: DataFrame) -> DataFrame:
    return violations(games, "game_pk", transformed_rules())


def key_difference(expected: DataFrame, actual: DataFrame, key: str = "game_pk") -> DataFrame:
    """Keys that two lists do not hold equally often: key, difference (actual less expected). One shuffle."""
    signed = expected.select(F.col(key).alias("key"), F.lit(-1).alias("n")).unionAll(actual.select(F.col(key), F.lit(1)))
    return signed.groupBy("key").agg(F.sum("n").alias("difference")).where("difference <> 0")


def stats_rules() -> dict[str, Column]:
    """Player rows: all context is there and at least one section is not null ({} counts as a section)."""
    context = {f"missing {c}": F.col(c).isNotNull() for c in ("game_pk", "player_id", "team_id", "position_code", "position_name")}
    return context | {"no section": _any_section()}


def stats_violations(players: DataFrame) -> DataFrame:
    return violations(players, "player_id", stats_rules())


def _any_section() -> Column:
    return F.col("batting").isNotNull() | F.col("pitching").isNotNull() | F.col("fielding").isNotNull()


def section_violations(players: DataFrame) -> DataFrame:
    """Player rows without any section."""
    return violations(players, "player_id", {"no section": _any_section()})


def load_count(scheduled: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row: scheduled, loaded, ok."""
    both = scheduled.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(0).alias("side")).union(
        loaded.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(1).alias("side"))
    )
    one = [F.max(F.when(F.col("side") == i, F.col("n"))).alias(c) for i, c in enumerate(("scheduled", "loaded"))]
    return both.agg(*one).withColumn("ok", F.col("scheduled") == F.col("loaded"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


#: Bitmaps of so many blocks of 32,768 ids (4 KiB each) are broadcast; beyond, they are joined by shuffling.
BITMAPS = 8192


def key_bitmaps(rows: DataFrame, key: str) -> DataFrame:
    """block, bits: which whole numbers occur in a column, as a bit for each; null keys are left out."""
    some = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"))
    return some.groupBy(F.bitmap_bucket_number("k").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("k")).alias("bits"))


def in_bitmap(bits: Column, key: Column) -> Column:
    """Whether a block's bits hold a key of that block."""
    place = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0


def orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key, a whole number, has no parent; null keys are no orphans.

    Parents become bitmaps, which are broadcast while they are few; then rows are tested where they are, without a shuffle.
    """
    checkpoint_folder(rows.sparkSession)
    bitmaps = key_bitmaps(parents, key).checkpoint()
    few = F.broadcast(bitmaps) if bitmaps.count() <= BITMAPS else bitmaps
    own = F.col(key).cast("long")
    both = rows.alias("r").join(few.alias("b"), F.bitmap_bucket_number(own) == F.col("b.block"), "left")
    known = F.col("b.bits").isNotNull() & F.coalesce(in_bitmap(F.col("b.bits"), own), F.lit(False))
    return both.where(F.col(key).isNotNull() & ~known).select("r.*")


def constraint_violations(fact: DataFrame) -> DataFrame:
    """Fact rows: keys are there, metrics fit their decimals, texts their lengths."""
    digits = {"bat_wrc_plus": 4, "bat_home_run_rate": 4, "pit_innings_pitched": 2, "pit_fip": 3, "pit_home_run_rate": 4, "fld_fielding_runs": 2}
    rules = {f"{c} is null": F.col(c).isNotNull() for c in ("game_pk", "player_id", "team_id")}
    rules |= {f"{c} overflows": F.col(c).isNull() | (F.abs(c) < 10 ** digits.get(c, 1)) for c in METRICS if c in FACT}
    rules["position_code too long"] = F.col("position_code").isNull() | (F.length("position_code") <= 4)
    rules["position_name too long"] = F.col("position_name").isNull() | (F.length("position_name") <= 64)
    return violations(fact, "game_pk", rules)


def latest_loads(audit: DataFrame) -> DataFrame:
    """pipeline_name, loaded_at of each pipeline's latest load; a null time counts as the latest."""
    unknown = F.bool_or(F.col("loaded_at").isNull())
    return audit.groupBy("pipeline_name").agg(F.when(~unknown, F.max("loaded_at")).alias("loaded_at"))


def freshness(audit: DataFrame, now: str, hours: int = 24) -> DataFrame:
    """pipeline_name, loaded_at, status: 'fresh', 'stale' (strictly older than the limit) or 'none'."""
    limit = F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(hours))
    status = F.when(F.col("loaded_at").isNull(), "none").when(F.col("loaded_at") < limit, "stale").otherwise("fresh")
    return latest_loads(audit).withColumn("status", status)


def require_fresh(audit: DataFrame, name: str, now: str, hours: int = 24) -> None:
    row = freshness(audit.where(F.col("pipeline_name") == name), now, hours).first()
    if row is None or row["status"] == "none":
        raise QualityError(f"{name} has no recorded load")
    if row["status"] == "stale":
        raise QualityError(f"{name}: the latest load is older than {hours} h")


def rolling_ready(rolling: DataFrame, yesterday: str) -> DataFrame:
    """One row: latest date and whether it reaches yesterday."""
    day = F.lit(yesterday).cast("date")
    latest = rolling.agg(F.max("as_of_date").alias("latest"))
    return latest.withColumn("ready", F.coalesce(F.col("latest") >= day, F.lit(False)))
