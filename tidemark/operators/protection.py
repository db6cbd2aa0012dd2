"""Column masks, row filters, secured views and tag-driven policies as DataFrame operators.

Who the caller is, the tags and the policies are small inputs on the driver; they are compiled to one
`select` and one filter over the table. A caller sees masked data unless a group of theirs is excepted.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.masks import MASKS
from tidemark.operators.common import as_predicate, col, require_columns

Mask = str | Callable[[Column], Column]
Tags = Mapping[str, str]

AUDIT_COLUMNS = (
    "step",
    "target",
    "status",
    "message",
    "execution_timestamp",
    "pipeline_name",
    "query_statement",
)


def mask_function(mask: Mask) -> Callable[[Column], Column]:
    if callable(mask):
        return mask
    if mask not in MASKS:
        raise ValueError(f"unknown mask {mask!r}; known masks: {sorted(MASKS)}")
    return MASKS[mask]


def apply_column_masks(
    df: DataFrame,
    bindings: Mapping[str, Mask],
    groups: Collection[str] = (),
    except_groups: Collection[str] = ("admins",),
) -> DataFrame:
    """Replace bound columns by their masks, unless the caller is in an excepted group."""
    require_columns(df, list(bindings), "apply_column_masks")
    if set(groups) & set(except_groups):
        return df
    return df.select(*[mask_function(bindings[c])(col(c)).alias(c) if c in bindings else col(c) for c in df.columns])


@dataclass(frozen=True)
class MaskedColumn:
    """A column of a secured view: masked for callers in any of `groups` (for everyone if None)."""

    column: str
    mask: Mask
    groups: Collection[str] | None = None


def secured_view(
    df: DataFrame,
    masked: Sequence[MaskedColumn],
    groups: Collection[str] = (),
    except_groups: Collection[str] = ("admins",),
    deny_by_default: bool = True,
) -> DataFrame:
    """A view that masks a column for callers who meet its condition.

    Callers in no group the view mentions are masked too, unless `deny_by_default` is off.
    """
    require_columns(df, [m.column for m in masked], "secured_view")
    caller = set(groups)
    if caller & set(except_groups):
        return df
    bindings = {
        m.column: m.mask for m in masked if m.groups is None or deny_by_default or caller & set(m.groups)
    }
    return apply_column_masks(df, bindings, groups, ())


def apply_row_filter(df: DataFrame, column: str, allowed: DataFrame | Collection[str]) -> DataFrame:
    """Rows whose `column` is among the allowed values; none at all if nothing is allowed.

    A collection becomes an IN filter that reaches the scan. A one-column DataFrame of grants becomes
    a semi join, whose strategy Spark picks by the size of the grants.
    """
    require_columns(df, [column], "apply_row_filter")
    if isinstance(allowed, str):
        raise TypeError("apply_row_filter: give a collection of allowed values, not one string")
    if not isinstance(allowed, DataFrame):
        return df.where(col(column).isin(list(allowed))) if allowed else df.where(F.lit(False))
    grants = allowed.select(col(allowed.columns[0]).alias("_allowed"))
    return df.join(grants, df[f"`{column}`"] == grants["_allowed"], "left_semi")


@dataclass(frozen=True)
class Policy:
    """Mask or filter every column that carries a tag, on tables that carry a tag.

    `kind` is "mask" or "filter"; `when` is the (key, value) the table must carry; `match` the (key,
    value) the column must carry, any value if None. A filter policy on an ambiguous tag must name its
    column in `on_column`. `scope` names what it holds for: nothing (everywhere), a catalog, a schema in it or one table
    (`main`, `main.gold`, `main.gold.customers`).
    """

    name: str
    kind: str
    match: tuple[str, str | None]
    mask: Mask | None = None
    when: tuple[str, str] | None = None
    to: Collection[str] = ()
    except_: Collection[str] = ()
    on_column: str | None = None
    scope: str = ""

    def covers(self, table: str | None) -> bool:
        """Whether the full name of a table lies within the scope, name by name."""
        if not self.scope:
            return True
        if table is None:
            raise ValueError(f"policy {self.name} has the scope {self.scope}: name the table")
        within, parts = self.scope.lower().split("."), table.lower().split(".")
        return parts[: len(within)] == within

    def binds(self, groups: Collection[str], deny_by_default: bool) -> bool:
        caller = set(groups)
        if caller & set(self.except_):
            return False
        return deny_by_default or not self.to or bool(caller & set(self.to))


def check_tags(tags: Mapping[str, Tags], allowed: Mapping[str, Collection[str]]) -> None:
    """Raise on a tag whose key or value is not governed."""
    for owner, pairs in tags.items():
        for key, value in pairs.items():
            if key not in allowed:
                raise ValueError(f"tag {key!r} on {owner!r} is not governed")
            if value not in allowed[key]:
                raise ValueError(f"tag {key}={value!r} on {owner!r}: allowed values are {sorted(allowed[key])}")


def resolve_policies(
    columns: Sequence[str],
    table_tags: Tags,
    column_tags: Mapping[str, Tags],
    policies: Sequence[Policy],
    groups: Collection[str],
    deny_by_default: bool = True,
    table: str | None = None,
) -> tuple[dict[str, Mask], list[str]]:
    """(mask per column, columns to filter) for one caller on one table, given by its full name if policies have scopes."""
    masks: dict[str, Mask] = {}
    owners: dict[str, str] = {}
    filters: list[str] = []
    for policy in policies:
        if policy.kind not in ("mask", "filter"):
            raise ValueError(f"policy {policy.name}: kind must be 'mask' or 'filter'")
        if not policy.covers(table):
            continue
        if policy.when and table_tags.get(policy.when[0]) != policy.when[1]:
            continue
        if not policy.binds(groups, deny_by_default):
            continue
        key, value = policy.match
        hits = [c for c in columns if key in column_tags.get(c, {}) and value in (None, column_tags[c][key])]
        if policy.on_column is not None:
            if policy.on_column not in hits:
                raise ValueError(f"policy {policy.name}: column {policy.on_column!r} does not carry its tag")
            hits = [policy.on_column]
        if policy.kind == "filter":
            if len(hits) > 1:
                raise ValueError(f"policy {policy.name} matches {hits}; name one column")
            filters += hits
            continue
        if policy.mask is None:
            raise ValueError(f"policy {policy.name}: a mask policy needs a mask")
        for name in hits:
            if name in masks and masks[name] != policy.mask:
                raise ValueError(f"policies {owners[name]} and {policy.name} mask {name!r} differently")
            masks[name], owners[name] = policy.mask, policy.name
    return masks, filters


def apply_policies(
    df: DataFrame,
    table_tags: Tags,
    column_tags: Mapping[str, Tags],
    policies: Sequence[Policy],
    groups: Collection[str],
    allowed_values: DataFrame | Collection[str] = (),
    governed_tags: Mapping[str, Collection[str]] | None = None,
    deny_by_default: bool = True,
    table: str | None = None,
) -> DataFrame:
    """The table as this caller may see it: filtered on clear values first, then masked."""
    if governed_tags is not None:
        check_tags({"table": table_tags, **column_tags}, governed_tags)
    masks, filters = resolve_policies(df.columns, table_tags, column_tags, policies, groups, deny_by_default, table)
    for column in filters:
        df = apply_row_filter(df, column, allowed_values)
    return apply_column_masks(df, masks, groups, ())


@dataclass(frozen=True)
class Control:
    """One applied control to report on: a column mask, or a row filter given by its condition."""

    step: str
    target: str
    statement: str
    mask: Mask | None = None
    keep: str | Column | None = None


def protection_audit(df: DataFrame, controls: Sequence[Control], pipeline_name: str = "unknown") -> DataFrame:
    """One row per control in the seven-column audit shape, counted in one pass over the table.

    A mask fails when it leaves some value as it was. A filter reports the rows it hides.
    """
    for control in controls:
        if (control.mask is None) == (control.keep is None):
            raise ValueError(f"control {control.target}: give either a mask or a row condition")
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, control in enumerate(controls):
        if control.mask is not None:
            value = col(control.target)
            hidden = ~mask_function(control.mask)(value).eqNullSafe(value.cast("string"))
            measures += [F.count_if(value.isNotNull()).alias(f"_of_{i}"), F.count_if(hidden).alias(f"_hit_{i}")]
        else:
            measures += [
                F.count(F.lit(1)).alias(f"_of_{i}"),
                F.count_if(~as_predicate(control.keep)).alias(f"_hit_{i}"),
            ]
    counted = df.agg(*measures)

    lines = []
    for i, control in enumerate(controls):
        of, hit = F.col(f"_of_{i}"), F.col(f"_hit_{i}")
        status = F.when(hit == of, "OK").otherwise("FAIL") if control.mask is not None else F.lit("OK")
        verb = "masked" if control.mask is not None else "hidden"
        message = F.format_string(f"rows seen %d, {verb} %d of %d", F.col("_rows"), hit, of)
        values = [
            F.lit(control.step),
            F.lit(control.target),
            status,
            message,
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            F.lit(pipeline_name),
            F.lit(control.statement),
        ]
        lines.append(F.struct(*[v.alias(name) for v, name in zip(values, AUDIT_COLUMNS, strict=True)]))
    return counted.select(F.inline(F.array(*lines)))


def audit_summary(audit: DataFrame) -> DataFrame:
    """Controls per step and status."""
    return audit.groupBy("step", "status").agg(F.count(F.lit(1)).alias("controls"))
