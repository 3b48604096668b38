"""Long series computed unit by unit, so that a run takes up where the last one ended.

A unit (a site, year and variant) is finished when its rows and its line in the ledger were published,
which happens in one commit. Wanted units are laid against the ledger before any pixel is read; those
of the year in progress, and those made with other parameters, are computed again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.operators import radar as ra
from sluice.session import cut_lineage
from sluice.sources.snapshots import SnapshotStore


def pending_units(
    wanted: DataFrame, ledger: DataFrame | None, keys: Sequence[str], parameters: str, redo: Column
) -> DataFrame:
    """Wanted units that the ledger does not hold as closed under these parameters, and all that `redo`
    marks. A unit computed while `redo` marked it (its year was in progress) is not `closed`."""
    again = F.coalesce(redo, F.lit(False))
    wanted = wanted.select(*keys).distinct().withColumn("closed", ~again)
    if ledger is None:
        return wanted
    done = ledger.where((F.col("parameters") == parameters) & F.col("closed")).select(*keys)
    return wanted.where(again).unionByName(wanted.where(~again).join(done, list(keys), "left_anti"))


def resume(
    store: SnapshotStore,
    table: str,
    wanted: DataFrame,
    keys: Sequence[str],
    parameters: str,
    redo: Column,
    compute: Callable[[DataFrame], DataFrame],
    year: str = "annee",
    years_per_commit: int = 1,
) -> list[int]:
    """Compute the pending units and publish them with their ledger (`<table>_units`), a commit for each
    year (or few) from the first on: a run that dies keeps the years it published. `compute` gets the
    units of a commit as a written table, so that a scan partitioned by site and year is pruned by them,
    and returns rows with the unit's keys. A unit may have no rows. Gives the snapshots published."""
    units, made = f"{table}_units", []
    ledger = store.read(units) if store.has(units) else None
    todo = cut_lineage(pending_units(wanted, ledger, keys, parameters, redo))
    years = sorted(r[0] for r in todo.select(year).distinct().collect())  # a short list
    for i in range(0, len(years), years_per_commit):
        some = years[i : i + years_per_commit]
        mine = cut_lineage(todo.where(F.col(year).isin(some)))
        rows = compute(mine.select(*keys))
        with store.transaction() as t:
            line = mine.withColumn("parameters", F.lit(parameters)).withColumn("snapshot", F.lit(t.base + 1).cast("long"))
            for name, new in ((table, rows), (units, line)):
                if name in t.tables:
                    old = t.read(name, map(str, some)).join(mine, list(keys), "left_anti")
                    new = old.unionByName(new.select(*old.columns))
                t.replace_parts(name, new, year, keys, also=map(str, some))
        made.append(t.version)
    return made


def _of_units(pixels: DataFrame, units: DataFrame, year: Column) -> DataFrame:
    """The pixels of the sites and years of the units."""
    few = units.select("marais", "annee").distinct()
    return pixels.withColumn("annee", year).join(few, ["marais", "annee"], "left_semi").drop("annee")


def resume_passages(
    store: SnapshotStore,
    passes: DataFrame,
    pixels: DataFrame,
    domain: DataFrame,
    regimes: Sequence[str],
    pixel_ha: float,
    today: Column,
    parameters: str,
    variants: Sequence[str] = ("hydro", "fixe"),
    period: tuple[int, int] | None = None,
    months: Sequence[int] = ra.DRY_MONTHS,
    years_per_commit: int = 1,
    **settings,
) -> tuple[list[int], list[int]]:
    """`radar.passages` of a growing archive. `passes` (marais, date) lists the passes that exist;
    `pixels` is read for pending units only: first the dry season of each year without a stored
    reference and whose season is over (table `references`), then the passes of each pending year (table
    `passages`). The fixed reference is made of the stored yearly ones. A changed fixed reference does not
    reopen finished years, as published values stay; a new value of `parameters` reopens all."""
    passes = passes.select("marais", "date").distinct()
    site = F.year("date").alias("annee")
    dry = passes.where(F.month("date").isin(list(months)))
    over = cal.season_complete(F.year("date"), today, max(months))
    yearly = resume(
        store, "references", dry.where(over).select("marais", site), ["marais", "annee"], parameters, F.lit(False),
        lambda units: ra.yearly_reference(_of_units(pixels, units, F.year("date")), ["marais"], months),
        years_per_commit=years_per_commit,
    )
    if not store.has("references"):
        references = ra.yearly_reference(pixels.limit(0), ["marais"], months)
    else:
        references = store.read("references")
    refs = cut_lineage(ra.with_fixed_reference(references, ["marais"], period).where(F.col("variante").isin(list(variants))))
    smooth = ra.smooth_references(refs, domain)
    wanted = passes.select("marais", site, F.explode(F.array(*[F.lit(v) for v in variants])).alias("variante"))

    def compute(units: DataFrame) -> DataFrame:
        asked = passes.withColumn("annee", F.year("date")).join(units, ["marais", "annee"])
        found = ra.detect_passes(
            _of_units(pixels, units, F.year("date")), asked.drop("annee"), smooth, domain, regimes, pixel_ha, **settings
        )
        return found.withColumn("annee", F.year("date"))

    keys = ["marais", "annee", "variante"]
    open_year = F.col("annee") >= F.year(today)
    return yearly, resume(store, "passages", wanted, keys, parameters, open_year, compute, years_per_commit=years_per_commit)
