"""Keyed merge of many metric sections into one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import project, q


def merge_sections(sections: Mapping[str, DataFrame], keys: Sequence[str],
                   markers: bool = True) -> DataFrame:
    """Full outer merge of sections that each hold at most one row per key.

    Every section's columns travel as one struct; the union of all sections is
    grouped by the keys once and each group takes the one struct of every
    section it has.  One exchange serves the whole merge, where a full outer
    join per section would shuffle the growing row each time (its output is no
    longer partitioned by the coalesced keys).  Keys that only one section
    knows stay; keys with a null do too, as one group.  ``has_<section>`` tells
    "section row absent" apart from "value null".
    """
    owner: dict[str, str] = {}
    union: DataFrame | None = None
    picked = []
    for name, df in sections.items():
        cols = [c for c in df.columns if c not in keys]
        for c in cols:
            if c in owner:
                raise ValueError(f"column {c} produced by both {owner[c]} and {name}")
            owner[c] = name
        s = q(f"__s_{name}")
        part = project(df, [*((k, q(k)) for k in keys),
                            (f"__s_{name}", "struct(" + ", ".join(map(q, cols or keys)) + ")")])
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
        picked += [(c, f"{s}.{q(c)}") for c in cols]
        if markers:
            picked.append((f"has_{name}", f"{s} IS NOT NULL"))
    structs = [c for c in union.columns if c not in keys]
    merged = union.groupBy(*keys).agg(*[F.any_value(c, F.lit(True)).alias(c) for c in structs])
    return project(merged, [*((k, q(k)) for k in keys), *picked])
