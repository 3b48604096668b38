"""The weekly chain: stations, zones, composite, with their frozen references.

Order: station normals, raw zone means, zone references, restandardised zones, raw composite,
composite reference, restandardised composite. Each table that several steps read is written once
and read back, so the plans stay short and a lost executor replays one step only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.operators import indices as ix
from sluice.operators import reference as ref
from sluice.session import cut_lineage

STATION_INDICES = ("ips", "debit")


@dataclass(frozen=True)
class Settings:
    """Parameters of the chain; the defaults are those of the published method."""

    period: ref.ReferencePeriod
    windows: dict[str, int] = field(
        default_factory=lambda: {"spi_1": 30, "spi_3": 91, "spi_6": 182}
    )
    month_days_min: int = 10
    age_max: int = 365
    fresh_days: int = 45
    q7_days_min: int = 5
    half_window: int = 15
    window_share: float = 0.5
    weeks_min: int = 26
    version: str = "1"


@dataclass(frozen=True)
class Inputs:
    """groundwater, flow: station_id, date, value. rain: zone_id, date, value on every day.
    stations: station_id, zone_id. weights: zone_id, indice, poids. campaigns may be absent."""

    groundwater: DataFrame
    flow: DataFrame
    rain: DataFrame
    stations: DataFrame
    weights: DataFrame
    campaigns: DataFrame | None = None
    breaks: DataFrame | None = None
    regime_zones: DataFrame | None = None


def station_normals(
    inputs: Inputs, s: Settings, keep: Callable[[DataFrame], DataFrame] = cut_lineage
) -> dict[str, DataFrame]:
    """Normals per station and zone, with the rolling series they come from. Rolling series and
    normals are read by every later step, so each goes through `keep`."""
    monthly = ref.monthly_means(
        inputs.groundwater, "station_id", "date", "value", s.month_days_min
    )
    rolling = keep(
        ref.rolling_mean_min(inputs.flow, ["station_id"], "date", "value", 7, s.q7_days_min)
    )
    totals = keep(ref.rolling_sum_full(inputs.rain, ["zone_id"], "date", "value", s.windows))
    flow = ref.flow_normals(
        rolling, "station_id", "date", "q7", s.period, s.half_window, s.window_share, inputs.breaks
    )
    return {
        "ips": keep(ref.groundwater_normals(monthly, "station_id", s.period, inputs.breaks)),
        "debit": keep(flow),
        "spi": keep(ref.spi_normals(totals, "zone_id", "date", s.period)),
        "rolling": rolling,
        "totals": totals,
    }


def station_indices(
    inputs: Inputs, normals: dict[str, DataFrame], s: Settings, start: Column, end: Column
) -> DataFrame:
    level = ix.groundwater_index(
        inputs.groundwater, normals["ips"], "station_id", "date", "value", start, end,
        s.month_days_min, s.age_max, s.fresh_days,
    )
    flow = ix.flow_index(normals["rolling"], normals["debit"], "station_id", "date", start, end)
    return ix.finalise(level.unionByName(flow), s.version)


def raw_zones(
    inputs: Inputs,
    normals: dict[str, DataFrame],
    stations_indices: DataFrame,
    start: Column,
    end: Column,
) -> tuple[DataFrame, DataFrame]:
    """(rain indices, means of the station indices) before restandardisation."""
    spi = ix.spi_index(normals["totals"], normals["spi"], "zone_id", "date", start, end)
    return spi, ix.zone_mean(stations_indices, inputs.stations)


def _values(table: DataFrame) -> DataFrame:
    return table.select("zone_id", "semaine", "indice", "valeur")


def zone_references(
    inputs: Inputs, spi: DataFrame, means: DataFrame, s: Settings
) -> tuple[DataFrame, DataFrame]:
    """(reference of the zone means, reference of the composite), from raw values over the whole
    history up to the year of the freeze."""
    last = f"{s.period.freeze or s.period.end}-W53"
    early = F.col("semaine") <= last
    zone_refs = ref.rank_reference(
        means.where(early), ["zone_id", "indice"], s.period, s.weeks_min
    )
    ranked = ix.restandardise(means.where(early), zone_refs, ["zone_id", "indice"])
    values = _values(ranked).unionByName(_values(spi.where(early)))
    composites = ix.composite(values, inputs.weights).select(
        "zone_id", "semaine", "valeur", F.col("detail.partiel").alias("partiel")
    )
    if inputs.regime_zones is None:
        composite_refs = ref.rank_reference(composites, ["zone_id"], s.period, s.weeks_min)
    else:
        composite_refs = ref.composite_reference(
            composites, inputs.regime_zones, s.period, s.weeks_min
        )
    return zone_refs, composite_refs


def weekly_tables(
    inputs: Inputs,
    s: Settings,
    start: str,
    end: str,
    normals: dict[str, DataFrame] | None = None,
    references: tuple[DataFrame, DataFrame] | None = None,
    history: str | None = None,
    keep: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> dict[str, DataFrame]:
    """indice_station, indice_zone and composite_zone of the weeks `start` to `end`.

    `normals` and `references` are the stored tables of earlier runs. Without them they are built
    here, the zone references from the weeks since `history` (by default `start`). Tables that
    several later steps read go through `keep`, which writes them once: by default a checkpoint."""
    normals = normals or station_normals(inputs, s)
    since = start if references is not None else min(history or start, start)
    first, last = cal.week_sunday(F.lit(since)), cal.week_sunday(F.lit(end))
    by_station = keep(station_indices(inputs, normals, s, first, last))
    spi, means = (keep(x) for x in raw_zones(inputs, normals, by_station, first, last))
    if references is None:
        references = tuple(keep(x) for x in zone_references(inputs, spi, means, s))
    zone_refs, composite_refs = references

    def asked(table: DataFrame) -> DataFrame:
        return table.where((F.col("semaine") >= start) & (F.col("semaine") <= end))

    ranked = ix.restandardise(asked(means), zone_refs, ["zone_id", "indice"])
    raw = ix.composite(_values(asked(spi)).unionByName(_values(ranked)), inputs.weights)
    composites = ix.restandardise(raw, composite_refs, ["zone_id"])
    zones = ix.finalise(ix.with_detail_text(asked(spi)), s.version).unionByName(
        ix.finalise(ix.with_detail_text(ranked), s.version)
    )
    if inputs.campaigns is not None:
        share = asked(ix.campaign_share(inputs.campaigns, inputs.stations))
        zones = zones.unionByName(ix.finalise(ix.with_detail_text(share), s.version, False))
    return {
        "indice_station": asked(by_station),
        "indice_zone": zones,
        "composite_zone": ix.finalise(composites, s.version),
    }


def raw_tables(
    inputs: Inputs, s: Settings, start: str, end: str, normals: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Zone indices without restandardisation, from which references are built."""
    normals = normals or station_normals(inputs, s)
    first, last = cal.week_sunday(F.lit(start)), cal.week_sunday(F.lit(end))
    by_station = station_indices(inputs, normals, s, first, last)
    spi, means = raw_zones(inputs, normals, by_station, first, last)
    return _values(spi).unionByName(_values(means))
