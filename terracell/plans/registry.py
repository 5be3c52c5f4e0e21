"""Named variables: what each one needs, how its arguments are checked, and how to compute it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from enum import Enum
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.attributes import merge_by_id
from ..operators.raster import RasterGrid
from ..sources.layers import BORDER_COLUMNS, BorderType, Layers


# Names and radii of the buffer sizes, and the texts of refused arguments below.
class BufferSize(Enum):
    VERY_SMALL = 100
    SMALL = 300
    MEDIUM = 500
    LARGE = 1000
    VERY_LARGE = 5000


class NdviBufferSize(Enum):
    LARGE = 1000
    VERY_LARGE = 5000


class EmissionBufferSize(Enum):
    SMALL = 3000
    MEDIUM = 10000
    LARGE = 20000


EVERY_FIVE = (2000, 2005, 2010, 2015, 2020)
FROM_2005 = (2005, 2010, 2015, 2020)
TWO_LATEST = (2015, 2020)

# Columns of the county that a result may carry beside its key.
COUNTY = ("sgg_cd",)

UNIT_BORDER, UNIT_CENTER, UNIT_POINT = "border", "center", "point"
CENTER_CODE, POINT_ID = "tot_reg_cd", "point_id"


@dataclass(frozen=True)
class Variable:
    """One variable.  ``build(request)`` returns a DataFrame with one row per unit."""

    name: str
    unit: str
    build: Callable[[Request], DataFrame]
    years: tuple[int, ...] = ()
    radii: type[Enum] | None = None
    remap: dict[int, int] = field(default_factory=dict)
    options: dict[str, tuple] = field(default_factory=dict)
    # Further options, and the border type where none is named.
    extras: tuple[str, ...] = ()
    border: str = "sgg"

    def key(self, border_type: str | None) -> str:
        """The column that names a row's unit."""
        if self.unit == UNIT_BORDER:
            return BORDER_COLUMNS[border_type or self.border][0]
        return POINT_ID if self.unit == UNIT_POINT else CENTER_CODE


@dataclass(frozen=True)
class Request:
    """Checked arguments of one computation."""

    layers: Layers
    grid: RasterGrid | dict[str, RasterGrid] | None = None
    asked_year: int | None = None
    year: int | None = None
    radius: int | None = None
    border_type: str = "sgg"
    options: dict[str, Any] = field(default_factory=dict)
    units: DataFrame | None = None

    def border(self) -> tuple[DataFrame, str]:
        return self.layers.border(self.border_type, self.year)

    def raster(self, name: str) -> RasterGrid:
        """The georeference of a raster: one for all, or one by name (dem, dsm, ndvi, emission)."""
        found = self.grid.get(name) if isinstance(self.grid, dict) else self.grid
        if found is None:
            raise ValueError(f"Give the georeference of raster '{name}': grid=RasterGrid(x0, y0, size)")
        return found

    def centers(self) -> DataFrame:
        return self.units if self.units is not None else self.layers.get("centers")


VARIABLES: dict[str, Variable] = {}


def variable(name: str, unit: str, **spec: Any) -> Callable:
    def register(build: Callable[[Request], DataFrame]) -> Callable[[Request], DataFrame]:
        VARIABLES[name] = Variable(name, unit, build, **spec)
        return build

    return register


def validate_year(year: int | None, valid: tuple[int, ...]) -> None:
    if valid and year not in valid:
        raise ValueError(f"Invalid year {year}. Valid years are: {', '.join(map(str, valid))}")


def validate_choice(kind: str, plural: str, value: Any, valid: tuple) -> None:
    if value not in valid:
        raise ValueError(f"Invalid {kind} '{value}'. Valid {plural} are: {', '.join(map(str, valid))}")


def find(name: str) -> Variable:
    from . import borders, centers, points  # noqa: F401  (fills the registry)

    if name not in VARIABLES:
        raise ValueError(f"Unknown calculator type: {name}")
    return VARIABLES[name]


def checked(
    layers: Layers,
    name: str,
    year: int | None = None,
    radius: int | Enum | None = None,
    border_type: str | BorderType | None = None,
    grid: RasterGrid | dict[str, RasterGrid] | None = None,
    units: DataFrame | None = None,
    **options: Any,
) -> Request:
    """The checked arguments of one computation."""
    spec = find(name)
    validate_year(year, spec.years)
    radius = radius.value if isinstance(radius, Enum) else radius
    border_type = border_type.value if isinstance(border_type, BorderType) else border_type
    border_type = spec.border if border_type is None else border_type
    if spec.radii is not None:
        validate_choice("buffer size", "sizes", radius, tuple(e.value for e in spec.radii))
    if spec.unit != UNIT_POINT:
        validate_choice("border type", "types", border_type, tuple(e.value for e in BorderType))
    chosen = {}
    for option, valid in spec.options.items():
        value = options.pop(option, None)
        value = value.lower() if isinstance(value, str) else value
        validate_choice(option.replace("_", " "), option.split("_")[-1] + "s", value, valid)
        chosen[option] = value
    for option in options:
        validate_choice("option", "options", option, (*spec.options, *spec.extras))
    return Request(layers, grid, year, spec.remap.get(year, year), radius, border_type, chosen | options, units)


def compute(
    layers: Layers,
    name: str,
    year: int | None = None,
    radius: int | Enum | None = None,
    border_type: str | BorderType | None = None,
    grid: RasterGrid | dict[str, RasterGrid] | None = None,
    units: DataFrame | None = None,
    **options: Any,
) -> DataFrame:
    """DataFrame of one variable.  Arguments are checked before any plan is built."""
    return find(name).build(checked(layers, name, year, radius, border_type, grid, units, **options))


def compute_many(layers: Layers, wanted: list[dict[str, Any]], **shared: Any) -> DataFrame:
    """Several variables, years, radii merged into one frame by unit code.

    Each entry of ``wanted`` holds the arguments of one :func:`compute` call.  Results that would share a
    column name get the year appended, or their options where no year tells them apart. The county
    code that some carry is kept once.
    """
    frames, seen, key, copies, order = [], set(), None, set(), []
    calls = _share_overlaps(layers, [{**shared, **args} for args in wanted])
    counted = _share_counts(layers, calls)
    for i, args in enumerate(calls):
        spec = find(args["name"])
        code = spec.key(getattr(args.get("border_type"), "value", args.get("border_type")))
        if key is not None and code != key:
            raise ValueError(f"Cannot merge units '{key}' and '{code}'")
        key = code
        group = counted.get(i)
        df = group.column(i, code) if group else compute(layers, **args)
        again = {c: f"_{c}_{len(frames)}" for c in COUNTY if c in seen and c in df.columns}
        df = df.withColumnsRenamed(again)
        copies.update({(c, name) for c, name in again.items()})
        told = [args["year"]] if args.get("year") is not None else [args[o] for o in spec.options if o in args]
        renames = {c: "_".join([c, *map(str, told)]) for c in df.columns if c in seen}
        if len({*seen, *renames.values()}) < len(seen) + len(renames):
            raise ValueError(f"'{args['name']}' is asked for twice")
        df = df.withColumnsRenamed(renames)
        fresh = [c for c in df.columns if c != key]
        seen.update(fresh)
        order += [c for c in fresh if c not in again.values()]
        if group:
            group.named[i] = fresh[0]
        if not group or group.first == i:
            frames.append(group or df)
    frames = [f.frame(key) if isinstance(f, _Counted) else f for f in frames]
    merged = merge_by_id(frames, key or CENTER_CODE)
    for c in COUNTY:
        if c in merged.columns:
            merged = merged.withColumn(c, F.coalesce(c, *sorted(name for own, name in copies if own == c)))
    return merged.select(key or CENTER_CODE, *order)


class _Counted:
    """Counts of one layer that share a pass: the requests by the place of their calls, and their final columns."""

    def __init__(self, layer: str, requests: dict[int, tuple[str, Request]]):
        from .centers import COUNTS, count_many

        self.first, self.named = min(requests), {}
        self.requests = requests
        self.own = {i: COUNTS[n].column(r.year, r.radius) for i, (n, r) in requests.items()}
        self.place = {i: f"_{k}" for k, i in enumerate(requests)}
        self.counts = count_many(layer, list(requests.values()))

    def column(self, i: int, key: str) -> DataFrame:
        return self.counts.select(key, F.col(self.place[i]).alias(self.own[i]))

    def frame(self, key: str) -> DataFrame:
        return self.counts.select(key, *[F.col(self.place[i]).alias(name) for i, name in self.named.items()])


def _share_counts(layers: Layers, calls: list[dict[str, Any]]) -> dict[int, _Counted]:
    """The calls that count one layer for several years or radii, each with the pass that they share."""
    from .centers import COUNTS

    groups: dict[tuple, dict[int, tuple[str, Request]]] = {}
    for i, args in enumerate(calls):
        name = args["name"]
        if name in COUNTS:
            request = checked(layers, **args)
            groups.setdefault((COUNTS[name].layer, id(request.units)), {})[i] = (name, request)
    shared = {k: _Counted(k[0], g) for k, g in groups.items() if len(g) > 1}
    return {i: shared[k] for k, g in groups.items() if k in shared for i in g}


def _share_overlaps(layers: Layers, calls: list[dict[str, Any]]) -> list[dict[str, Any]]:
    """Let census variables of one year and radius use one overlap table, computed once.

    The table is checkpointed, so the variables neither repeat it nor depend on a cache.
    """
    from .centers import WEIGHTED, intersection_areas

    def key(args: dict[str, Any]) -> tuple | None:
        if args["name"] not in WEIGHTED or "overlaps" in args or "units" in args:
            return None
        radius = args.get("radius")
        border = args.get("border_type") or find(args["name"]).border
        return args.get("year"), radius.value if isinstance(radius, Enum) else radius, border, args.get("mode")

    keys = [key(args) for args in calls]
    tables: dict[tuple, DataFrame] = {}
    for k, args in zip(keys, calls):
        if k is not None and keys.count(k) > 1 and k not in tables:
            spec = find(args["name"])
            validate_year(k[0], spec.years)
            validate_choice("buffer size", "sizes", k[1], tuple(e.value for e in spec.radii))
            request = Request(layers, None, k[0], k[0], k[1], getattr(k[2], "value", k[2]))
            tables[k] = intersection_areas(request, k[3] or "border").checkpoint()
    return [{**args, "overlaps": tables[k]} if k in tables else args for k, args in zip(keys, calls)]
