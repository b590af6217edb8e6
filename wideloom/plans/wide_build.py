"""The customer-360 wide build: sections -> keyed merge -> cells -> export."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sqltext import project, q
from ..operators import aggregates as A
from ..operators import cells as C
from ..operators.aggregates import Section
from ..operators.export import typed_export
from ..operators.merge import merge_sections
from ..params import EVENT_ASOF, ORDER_ASOF, AsOf
from ..session import dropping_shuffles, shared_path
from ..sources import bindings as B
from . import sections as S
from .catalog import BY_NAME, CATALOG, ROW_KEY, VALUE_COLUMNS

# Signals that member-side sections read from the source passes; not sections of their own.
SIGNALS_OF = {"member_base": ("register", "channel_signup"), "active_flag": ("recent_message",)}
SIGNALS = {s for ss in SIGNALS_OF.values() for s in ss}


def source_passes(spark: SparkSession, d: str, order_asof: AsOf = ORDER_ASOF,
                  event_asof: AsOf = EVENT_ASOF, wanted: set[str] | None = None
                  ) -> dict[str, tuple[DataFrame, dict]]:
    """One aggregation per physical source: name -> (frame keyed by tenant and member, its
    sections).  With ``wanted`` (section names) a pass computes only those and the
    signals they read, reads only rows that one of them takes in, and is left out if none is."""
    need = None if wanted is None else wanted | {s for w in wanted for s in SIGNALS_OF.get(w, ())}

    def one_pass(facts: Callable[[], DataFrame], sections: dict[str, Section]) -> tuple[DataFrame, dict] | None:
        some = {k: v for k, v in sections.items() if need is None or k in need}
        if not some:
            return None
        predicates = [s.predicate if s.scan is None else s.scan for s in some.values()]
        prefilter = None if need is None or any(p is None for p in predicates) else reduce(or_, predicates)
        return A.sectioned_aggregate(S.keyed(facts()), S.KEYS, some, prefilter), some

    out = {"order_lines": one_pass(lambda: S.slot_lines(spark, d, order_asof), S.order_line_sections(order_asof)),
           "order_table": one_pass(lambda: B.order_facts(spark, d), S.order_table_sections(order_asof)),
           "events": one_pass(lambda: B.event_facts(spark, d), S.event_sections(event_asof))}
    if need is None or "top_items" in need:
        frame = S.top_items(spark, d, order_asof).withColumn("has_top_items", F.lit(True))
        out["top_items"] = frame, {"top_items": Section(tuple(A.Measure(c, None) for c in S.TOP_CODES + S.TOP_NAMES))}
    return {k: v for k, v in out.items() if v is not None}


def wide_sections(spark: SparkSession, d: str, order_asof: AsOf = ORDER_ASOF,
                  event_asof: AsOf = EVENT_ASOF, names: Iterable[str] | None = None
                  ) -> tuple[DataFrame, dict[str, str]]:
    """The merged profile and its presence map (column -> has_<section>).

    The member table and every source pass are merged by (tenant, member) as
    equals (``merge_sections``): a member without facts and a key that only
    facts know each get their row, and one member id at two tenants gets two.
    The passes are partitioned by the key already; only the member side is
    shuffled for it.  ``names`` limits the profile to some sections (a partial
    reload).
    """
    wanted = None if names is None else list(names)
    passes = source_passes(spark, d, order_asof, event_asof, None if wanted is None else set(wanted))
    # the shop organisation is only read by member_base; a partial reload
    # without it skips the customer-to-shop join (and its two shuffles)
    frames = {"members": S.keyed(S.member_frame(spark, d, with_shop=wanted is None or "member_base" in wanted))}
    frames |= {name: frame for name, (frame, _) in passes.items()}
    if wanted is not None and not S.MEMBER_SECTIONS & set(wanted):
        del frames["members"]
    wide = merge_sections(frames, S.KEYS, markers=False)
    section_cols: dict[str, list[tuple[str, str]]] = {}
    presence: dict[str, Column] = {}
    derived: dict[str, Column] = {}
    if "members" in frames:
        # signals that a pass left out or has no row for
        wide = wide.withColumns({f"has_{s}": F.coalesce(F.col(f"has_{s}"), F.lit(False)) if f"has_{s}" in wide.columns
                                 else F.lit(False) for s in SIGNALS})
        if "register_time" not in wide.columns:
            wide = wide.withColumn("register_time", F.lit(None).cast("date"))
        # member-side values are computed under private names (the member frame
        # uses lower-case names that would clash with the catalog names)
        presence |= {"member_base": S.member_base_pred(), "member_flag": S.member_flag_pred(),
                     "active_flag": S.active_flag_pred()}
        derived |= {f"__mb_{n}": c for n, c in zip(S.MEMBER_BASE_COLUMNS, S.member_base_columns(order_asof))}
        derived |= {"__mf": F.col("member_flg"), "__af": S.active_flag_column()}
        section_cols |= {"member_base": [(n, f"__mb_{n}") for n in S.MEMBER_BASE_COLUMNS] + S.ATTRIBUTES,
                         "member_flag": [("MEMBER_FLG", "__mf")],
                         "active_flag": [("IS_MP_ACITIVE_USER", "__af")]}
    for _, secs in passes.values():
        for name, sec in secs.items():
            if name not in SIGNALS:
                presence[name] = F.col(f"has_{name}")
                section_cols[name] = [(m.name, m.name) for m in sec.measures]
    wanted = wanted if wanted is not None else list(presence)
    staged = wide.select("*", *[c.alias(n) for n, c in derived.items()],
                         *[F.coalesce(presence[n], F.lit(False)).alias(f"__p_{n}") for n in wanted])
    pairs = [("tenant_id", "tenant_id"), ("member_id", "member_id"),
             (ROW_KEY, "concat(CAST(tenant_id AS STRING), '_', CAST(member_id AS STRING))")]
    pres_map = {}
    for name in wanted:
        flag = f"has_{name}"
        pairs.append((flag, q(f"__p_{name}")))
        for col_name, src in section_cols[name]:
            pairs.append((col_name, f"CASE WHEN {q(f'__p_{name}')} THEN {q(src)} END"))
            pres_map[col_name] = flag
    if "member_base" in wanted:
        pres_map["MEMBER_ID"] = pres_map["TENANT_ID"] = "has_member_base"
    keyed = project(staged, pairs)
    return keyed.filter(F.expr(" OR ".join(q(f"has_{n}") for n in wanted))), pres_map


def wide_profile(spark: SparkSession, d: str, order_asof: AsOf = ORDER_ASOF,
                 event_asof: AsOf = EVENT_ASOF) -> DataFrame:
    return wide_sections(spark, d, order_asof, event_asof)[0]


def profile_cells(wide: DataFrame, presence: dict[str, str], ts: int) -> DataFrame:
    """Cells of a merged profile; only columns of the declared catalog."""
    if "MEMBER_ID" in presence:
        wide = wide.withColumn("MEMBER_ID", F.col("member_id").cast("string")) \
                   .withColumn("TENANT_ID", F.col("tenant_id").cast("string"))
    families = {c: BY_NAME[c].cf for c in presence if c in BY_NAME}
    fmts = {c: BY_NAME[c].cell_date_format for c in families}
    return C.wide_to_cells(wide, ROW_KEY, families, ts, fmts, presence, S.AMOUNT_SCALES)


# The upsert scenario: a full load at an earlier as-of day, then a later load
# that rewrites only the time-window sections.
EARLIER_ORDER_ASOF = AsOf(dt.date(2001, 3, 15), slot=ORDER_ASOF.slot)
EARLIER_EVENT_ASOF = AsOf(dt.date(2024, 1, 15), slot=EVENT_ASOF.slot)
REFRESHED = ["order_30D", "order_90D", "order_120D", "order_180D", "order_360D",
             "recharge_30D", "recharge_90D", "recharge_180D", "recharge_360D", "coupon_recent", "active_flag"]
CORRECTED = ["coupon_recent", "order_30D", "member_flag"]
TS_FIRST, TS_SECOND = 1_000, 2_000


def staged_load(spark: SparkSession, cells: DataFrame) -> DataFrame:
    """The cells of one load, written below the shared folder and read back.

    Each load is a whole wide build: planned and run by itself, its shuffle files are gone before
    the next one starts, where one plan of all loads holds the files of every build at once."""
    path = shared_path(spark, "tables", f"cell_load_{uuid.uuid4().hex}")
    with dropping_shuffles(spark):
        cells.write.parquet(path)
    return spark.read.schema(C.CELL_SCHEMA).parquet(path)


def upserted_cells(spark: SparkSession, d: str) -> DataFrame:
    first = profile_cells(*wide_sections(spark, d, EARLIER_ORDER_ASOF, EARLIER_EVENT_ASOF), TS_FIRST)
    second = profile_cells(*wide_sections(spark, d, names=REFRESHED), TS_SECOND)
    return C.upsert_latest([staged_load(spark, first), staged_load(spark, second)])


def declared_columns() -> list[tuple[str, str]]:
    return [(c.cf, c.name) for c in VALUE_COLUMNS]


def exported(spark: SparkSession, d: str) -> DataFrame:
    wide = C.cells_to_wide(upserted_cells(spark, d), declared_columns(), ROW_KEY, deduplicated=True)
    return typed_export(wide, CATALOG)
