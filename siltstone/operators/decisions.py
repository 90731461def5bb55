"""Decision samples: what was known before, what was then done, and apart from both what followed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.contracts import COMPLETENESS, FORBIDDEN_NAMES, OBSERVED_ACTION, RECONSTRUCTION_LEVELS, DecisionContract
from siltstone.sources.tables import stored


#: Games of more rows are worked on in segments of about so many.
SEGMENT_ROWS = 500_000
#: Segments' bounds are looked up in lists of so many.
FAN = 64
#: Rows of small tables are broadcast up to so many.
FEW = 1_000_000


def _few(found: DataFrame) -> DataFrame:
    return F.broadcast(found) if found.count() <= FEW else found


def seen_before(events: DataFrame, contract: DecisionContract, held: list[str]) -> DataFrame:
    """``events`` with what came before each in its game, of the rows of one segment (``_segment``) of it.

    ``_known_<c>`` is the last value of each safe field, ``_history`` the last entries and ``_before``
    the number of rows at earlier positions.  ``_next`` is the action that follows.
    """
    game, position = contract.game, contract.position
    events = events.withColumn("_tie", F.xxhash64(*held))
    part = [game, "_segment"]
    order = Window.partitionBy(*part).orderBy(position, "_tie")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    # The first row of a position has nothing but earlier positions before it; its twins know the same.
    same = Window.partitionBy(*part, position).orderBy("_tie").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entry = F.struct(F.col(position).alias("position"), F.col(contract.action).alias("action"), *(F.col(c) for c in contract.safe))
    known = {f"_known_{c}": F.last(F.col(c), ignorenulls=True).over(past) for c in contract.safe}
    seen = events.withColumns({
        "_history": F.collect_list(entry).over(order.rowsBetween(-contract.history, -1)),
        "_before": F.rank().over(Window.partitionBy(*part).orderBy(position)).cast("long") - 1,
        **known,
        "_next": F.lead(contract.action).over(order),
        "_twins": F.count("*").over(Window.partitionBy(*part, position)),
    })
    return seen.withColumns({name: F.first(name).over(same) for name in ("_history", *known)})


def segment_bounds(events: DataFrame, game: str, position: str, segment_rows: int) -> DataFrame | None:
    """(_long, _coarse, _bounds) of the games of more rows than a segment, or None if there are none, stored.

    Bounds are approximate quantiles of the positions; what is exact follows from the rows on either side.
    """
    long = events.groupBy(F.col(game).alias("_long")).agg(F.count("*").alias("_rows")).where(F.col("_rows") > segment_rows)
    long = stored(long.select("_long", F.least(F.ceil(F.col("_rows") / segment_rows), F.lit(FAN * FAN)).cast("int").alias("_parts")), "long-games")
    if not long.head(1):
        return None
    kind = events.schema[position].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{position} has no quantiles: a game of over {segment_rows} rows can't be parted by it")
    most = long.agg(F.max("_parts")).first()[0]
    shares = [k / most for k in range(1, most)]
    found = events.join(_few(long), F.col(game).eqNullSafe(F.col("_long"))).groupBy("_long").agg(F.percentile_approx(position, shares, F.lit(10_000)).alias("_bounds"))
    found = found.select("_long", F.sort_array(F.array_distinct(F.coalesce("_bounds", F.array().cast(T.ArrayType(kind))))).alias("_bounds"))
    return stored(found.select("_long", F.filter("_bounds", lambda b, k: k % FAN == FAN - 1).alias("_coarse"), "_bounds"), "segment-bounds")


def in_segments(events: DataFrame, contract: DecisionContract, held: list[str], bounds: DataFrame) -> DataFrame:
    """``seen_before`` of games of any length: segments are worked on apart, and what each ends with is carried on.

    A segment holds whole positions.  Of each, one row is carried: its number of rows, last
    known values, last entries and first action.
    """
    game, position, k = contract.game, contract.position, contract.history
    joined = events.join(_few(bounds), F.col(game).eqNullSafe(F.col("_long")))
    below = lambda xs: F.size(F.filter(xs, lambda b: b < F.col(position)))
    first = F.coalesce(below("_coarse"), F.lit(0))
    segment = F.when(F.col(position).isNull(), -1).otherwise(first * FAN + below(F.slice("_bounds", first * FAN + 1, FAN)))
    dealt = joined.withColumn("_segment", segment).drop("_long", "_coarse", "_bounds")
    seen = seen_before(dealt, contract, held)
    # With themselves, rows show what their segment ends with; its last row is kept.
    order = Window.partitionBy(game, "_segment").orderBy(position, "_tie")
    entry = F.struct(F.col(position).alias("position"), F.col(contract.action).alias("action"), *(F.col(c) for c in contract.safe))
    whole = order.rowsBetween(Window.unboundedPreceding, 0)
    ends = {f"_end_{c}": F.last(F.col(c), ignorenulls=True).over(whole) for c in contract.safe}
    seen = stored(seen.withColumns({
        **ends,
        "_end": F.lead(F.lit(True)).over(order).isNull(),
        "_row": F.row_number().over(order).cast("long"),
        "_tail": F.collect_list(entry).over(order.rowsBetween(1 - k, 0)) if k else F.array().cast(seen.schema["_history"].dataType),
        "_opening": F.first(contract.action).over(whole),
    }), "segments")
    summary = seen.where("_end").select(F.col(game).alias("_game"), F.col("_segment").alias("_part"), "_row", "_tail", "_opening", *ends)
    run = Window.partitionBy("_game").orderBy("_part")  # a row for each segment
    last = lambda entries: F.slice(entries, F.greatest(F.size(entries) - k, F.lit(0)) + 1, F.lit(k))
    carried = summary.select(
        "_game", "_part",
        F.coalesce(F.sum("_row").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_rows_before"),
        last(F.flatten(F.collect_list("_tail").over(run.rowsBetween(-max(k, 1), -1)))).alias("_carried"),
        F.lead("_opening").over(run).alias("_following"),
        *(F.last(f"_end_{c}", ignorenulls=True).over(run.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_carried_{c}") for c in contract.safe),
    )
    carried = stored(carried, "carried")
    both = seen.join(_few(carried), F.col(game).eqNullSafe(F.col("_game")) & (F.col("_segment") == F.col("_part")))
    return both.select(
        *(F.col(f"`{c}`") for c in events.columns), "_segment", "_tie", "_twins",
        last(F.concat("_carried", "_history")).alias("_history"),
        (F.col("_before") + F.col("_rows_before")).alias("_before"),
        F.when(F.col("_end"), F.col("_following")).otherwise(F.col("_next")).alias("_next"),
        *(F.coalesce(f"_known_{c}", f"_carried_{c}").alias(f"_known_{c}") for c in contract.safe),
    )


def decision_samples(events: DataFrame, contract: DecisionContract, carry: tuple[str, ...] = (), segment_rows: int | None = SEGMENT_ROWS) -> DataFrame:
    """A row for each decision: sample_key, input, label, post_decision and statuses.

    ``input`` holds the declared safe fields alone, of rows before the decision:
    the last known value of each, and a bounded history.  Rows of a game of up to ``segment_rows`` lie in
    one task, sorted; longer games are parted by position, so that no task holds a whole one (rows
    at one position stay together).  With None nothing is counted first, and no game is parted.
    ``carry`` names columns, as of provenance, to keep as they are.

    Rows at one position know nothing of each other: what was known is of earlier
    positions alone.  They follow each other by what they hold, not as they come, so that
    every run gives the same.
    """
    game, position = contract.game, contract.position
    target = [contract.target] if contract.target else []
    held = [c for c in dict.fromkeys((contract.action, *contract.safe, *contract.outcome, *target, *carry)) if not isinstance(events.schema[c].dataType, T.MapType)]
    bounds = segment_bounds(events, game, position, segment_rows) if segment_rows else None
    if bounds is None:
        seen = seen_before(events.withColumn("_segment", F.lit(0)), contract, held)
    else:
        long = _few(bounds.select("_long"))
        short = events.join(long, F.col(game).eqNullSafe(F.col("_long")), "left_anti").withColumn("_segment", F.lit(0))
        seen = seen_before(short, contract, held).unionByName(in_segments(events, contract, held, bounds))
    action = F.col(contract.action)
    decided = seen.where(F.coalesce(action.isin(*contract.decisions), F.lit(False)) | action.isNull())
    action_status = F.when(action.isNull(), "missing").when(F.col("_twins") > 1, "ambiguous").otherwise("observed")
    complete = F.lit("unknown") if contract.unknown_fields else F.when(F.size("_history") < F.least(F.lit(contract.history).cast("long"), F.col("_before")), "partial").otherwise("complete_for_declared_view")
    flags = F.sort_array(F.array_compact(F.array(
        F.when(F.col("_before") == 0, "no_prior_rows"),
        F.when(F.col(game).isNull(), "no_game"),
        *(F.when(F.col(f"_known_{c}").isNull(), f"unknown_{c}") for c in contract.safe),
    )))
    samples = decided.select(
        F.col(game),
        F.col(position),
        F.lit(contract.version).alias("decision_contract_version"),
        F.struct(*(F.col(f"_known_{c}").alias(c) for c in contract.safe), F.col("_history").alias("history"), F.col("_before").alias("prior_rows")).alias("input"),
        F.struct(action.alias("observed_action"), F.lit("source_direct").alias("origin")).alias("label"),
        F.struct(F.col("_next").alias("next_action"), *(F.col(c) for c in contract.outcome)).alias("post_decision"),
        *([F.col(contract.actor).alias("actor")] if contract.actor else []),
        *(F.col(c) for c in carry),
        F.lit(contract.level).alias("reconstruction_level"),
        complete.alias("information_completeness"),
        F.lit("unknown").alias("legal_actions_status"),
        action_status.alias("observed_action_status"),
        *([F.when(F.col(contract.target).isNull(), "missing").otherwise("observed").alias("action_target_status")] if contract.target else []),
        flags.alias("state_quality_flags"),
    )
    return with_usability(samples)


def with_usability(samples: DataFrame) -> DataFrame:
    """``samples`` with ``usable_for_policy_imitation``, which is computed and never given."""
    if "usable_for_policy_imitation" in samples.columns:
        raise ValueError("usability is derived, it can't be an input")
    known = F.col("reconstruction_level").isin(*RECONSTRUCTION_LEVELS) & F.col("information_completeness").isin(*COMPLETENESS) & F.col("observed_action_status").isin(*OBSERVED_ACTION)
    good = (F.col("observed_action_status") == "observed") & F.col("reconstruction_level").isin(*RECONSTRUCTION_LEVELS[:2]) & (F.col("information_completeness") == COMPLETENESS[0]) & ~F.array_contains("state_quality_flags", "no_game")
    return samples.withColumn("usable_for_policy_imitation", F.coalesce(known & good, F.lit(False)))


def worst_level(*levels: Column) -> Column:
    """The least complete of the levels; an unknown one is the worst."""
    order = F.array(*map(F.lit, RECONSTRUCTION_LEVELS))
    ranks = [F.when(F.coalesce(F.array_position(order, x), F.lit(0)) > 0, F.array_position(order, x)).otherwise(len(RECONSTRUCTION_LEVELS)) for x in levels]
    return F.element_at(order, F.greatest(*ranks).cast("int") if len(ranks) > 1 else ranks[0].cast("int"))


def policy_view(samples: DataFrame) -> DataFrame:
    """Usable samples, without what followed."""
    return samples.where(F.coalesce(F.col("usable_for_policy_imitation"), F.lit(False))).drop("post_decision")


def leaks(samples: DataFrame, game: str, position: str) -> DataFrame:
    """Samples whose input reaches their own decision or beyond: there must be none."""
    return samples.where(F.exists("input.history", lambda h: h["position"] >= F.col(position))).select(game, position)


def input_violations(schema: T.StructType, safe: list[str]) -> list[str]:
    """Fields in ``input`` that are not declared safe."""
    allowed = {*safe, "history", "prior_rows", "position", "action"}
    found: list[str] = []

    def walk(kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.ArrayType):
            walk(kind.elementType, path)
        elif isinstance(kind, T.StructType):
            for f in kind.fields:
                if f.name not in allowed:
                    found.append(f"{path}.{f.name}")
                walk(f.dataType, f"{path}.{f.name}")

    walk(schema["input"].dataType, "input")
    return found


def forbidden_names(schema: T.StructType) -> list[str]:
    """Fields anywhere whose name claims more than was observed."""
    found: list[str] = []

    def walk(kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.ArrayType):
            walk(kind.elementType, path)
        elif isinstance(kind, T.StructType):
            for f in kind.fields:
                if f.name in FORBIDDEN_NAMES:
                    found.append(f"{path}{f.name}")
                walk(f.dataType, f"{path}{f.name}.")

    walk(schema, "")
    return found


def augment(core: DataFrame, layer: DataFrame, sample_id: str, name: str) -> DataFrame:
    """``core`` with another layer's row as one struct beside it; nothing of the core is overwritten."""
    facts = layer.select(sample_id, F.struct(*(c for c in layer.columns if c != sample_id)).alias(name))
    return core.join(facts, sample_id, "left")


def adapter(samples: DataFrame, columns: dict[str, Column], sample_id: str, lossy: list[str]) -> DataFrame:
    """A consumer's columns beside the sample's id; ``lossy`` names the samples' columns that they leave out.

    Refused before the run if a column takes the place of the id or of the
    contract's version, or if ``lossy`` names what samples don't have.
    """
    held = {sample_id, "decision_contract_version"}
    if taken := held & set(columns):
        raise ValueError(f"an adapter keeps {sorted(taken)} as they are")
    if unknown := set(lossy) - set(samples.columns):
        raise ValueError(f"samples have no {sorted(unknown)}")
    return samples.select(*sorted(held), *(c.alias(n) for n, c in columns.items()), F.array(*map(F.lit, sorted(lossy))).cast("array<string>").alias("lossy"))
