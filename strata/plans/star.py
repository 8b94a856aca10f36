"""Star-schema query layer: named measures over facts and dimensions.

A ``Star`` holds dimension and fact DataFrames, the fact->dimension
relationships (filters flow from a dimension to its facts only), the
measure definitions and, optionally, a row-level-security rule.

``Star.query(measures, by, principal)`` evaluates like a report tile:

1. security: the secured dimension is semi-joined with the caller's mapped
   values and every related fact is semi-joined on the surrogate key; columns
   that no role of the caller may see are masked wherever they are read;
2. per home table (a fact, or a dimension for distinct counts), join only
   the dimensions that carry ``by`` columns reachable from it, and
   aggregate -- facts are never joined to each other;
3. drill-across: the per-table aggregates are full-outer-joined on the
   slice columns (NULL-safe), so each measure keeps its own filter
   context; a measure whose table cannot reach some slice column, or that
   replaces the filter on it, is evaluated at the coarser grain that reaches it
   and repeated (an unrelated dimension does not filter it);
4. ratio measures are computed from the joined columns; rows where every
   requested measure is NULL are dropped; optional order and top-k.

Everything stays a lazy DataFrame plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.security import secure_dimension, secure_fact


@dataclass(frozen=True)
class Measure:
    """An aggregate over ``table``; ``needs`` names related-dimension columns
    ("dim.col") the aggregate reads row by row (a RELATED lookup).

    ``replaces`` names columns ("table.col") on which the measure sets a filter
    of its own: a slice on such a column does not reach it.  It is aggregated
    on the other slice columns and repeated along the replaced one.
    """
    name: str
    table: str
    agg: Callable[[], Column]
    needs: tuple[str, ...] = ()
    replaces: tuple[str, ...] = ()


@dataclass(frozen=True)
class Ratio:
    name: str
    num: str
    den: str
    digits: int | None = None


@dataclass(frozen=True)
class Relationship:
    """fact.fact_col -> dim.dim_col, many to one.  ``assume_ri`` declares
    that every fact key exists in the dimension (checked at load time by
    the orphan-key checks), which lets the lookup be an inner join."""
    fact: str
    fact_col: str
    dim: str
    dim_col: str
    assume_ri: bool = False


@dataclass(frozen=True)
class Security:
    dim: str
    attr: str
    mapping: DataFrame
    user_col: str = "user_email"
    value_col: str = "region"


@dataclass(frozen=True)
class ColumnPolicy:
    """Columns that only some roles may see.

    ``masks`` lists the governed columns ("table.col") with what others see
    instead (None: NULL); ``grants`` has (role, column), ``members`` has
    (user_email, role).  Without a grant a governed column is masked.
    """
    masks: dict[str, object]
    grants: DataFrame
    members: DataFrame

    def visible(self, principal) -> Column:
        """The governed columns that ``principal`` may see, as one array (a scalar subquery)."""
        p = F.lit(principal) if isinstance(principal, str) else principal
        roles = self.members.filter(F.lower("user_email") == F.lower(p)).select("role")
        return (self.grants.filter(F.col("column").isin(list(self.masks))).join(roles, "role", "left_semi")
                .agg(F.collect_set("column").alias("c")).scalar())


@dataclass(frozen=True)
class Star:
    dims: dict[str, DataFrame]
    facts: dict[str, DataFrame]
    relationships: tuple[Relationship, ...]
    measures: dict[str, Measure | Ratio] = field(default_factory=dict)
    security: Security | None = None
    policy: ColumnPolicy | None = None

    # -- security ------------------------------------------------------------
    def secured(self, principal) -> "Star":
        """The star as ``principal`` may see it; without one, as the session
        user may.  Seeing everything takes an explicit ``unsecured()``."""
        principal = F.session_user() if principal is None else principal
        return self._rows_for(principal)._columns_for(principal)

    def _columns_for(self, principal) -> "Star":
        """Governed columns masked unless one of the principal's roles may see them, in every table, so that
        slices, needs and measures alike read the masked ones."""
        if self.policy is None:
            return self
        keys = {f"{t}.{c}" for r in self.relationships for t, c in ((r.fact, r.fact_col), (r.dim, r.dim_col))}
        if keys & set(self.policy.masks):
            raise ValueError(f"keys cannot be masked: {sorted(keys & set(self.policy.masks))}")
        seen = self.policy.visible(principal)
        tables = {**self.dims, **self.facts}
        for ref, mask in self.policy.masks.items():
            t, c = self._owner(ref)
            shown = F.when(F.array_contains(seen, F.lit(ref)), F.col(c))
            tables[t] = tables[t].withColumn(c, shown.otherwise(F.lit(mask).cast(tables[t].schema[c].dataType)))
        return replace(self, dims={t: tables[t] for t in self.dims}, facts={t: tables[t] for t in self.facts}, policy=None)

    def _rows_for(self, principal) -> "Star":
        if self.security is None:
            return self
        s = self.security
        dim = secure_dimension(self.dims[s.dim], s.mapping, principal, s.attr,
                               s.user_col, s.value_col)
        dims = dict(self.dims, **{s.dim: dim})
        facts = dict(self.facts)
        for r in self.relationships:
            if r.dim == s.dim:
                facts[r.fact] = secure_fact(facts[r.fact], dim, r.dim_col, r.fact_col)
        return replace(self, dims=dims, facts=facts, security=None)

    def unsecured(self) -> "Star":
        """The whole star, for jobs that run on everyone's behalf."""
        return replace(self, security=None, policy=None)

    # -- helpers -------------------------------------------------------------
    def _owner(self, ref: str) -> tuple[str, str]:
        table, _, col = ref.partition(".")
        if not col:
            raise ValueError(f"slice column must be 'table.column', got {ref!r}")
        if table not in self.dims and table not in self.facts:
            raise KeyError(f"unknown table {table!r}")
        return table, col

    def _reach(self, table: str, by: Sequence[str]) -> list[str]:
        """Slice refs that filter ``table``."""
        out = []
        for ref in by:
            dim, _ = self._owner(ref)
            if table == dim or any(r.fact == table and r.dim == dim
                                   for r in self.relationships):
                out.append(ref)
        return out

    def _frame(self, table: str, refs: Sequence[str], needs: Sequence[str] = ()) -> DataFrame:
        """``table`` with slice columns (aliased to their column name) and
        needed dimension columns joined on; only the dimensions used."""
        # A slice on the table's own column is that column itself.
        df = self.dims.get(table, self.facts.get(table))
        wanted: dict[str, list[tuple[str, str]]] = {}
        for r in refs:
            t, c = self._owner(r)
            if t != table:
                wanted.setdefault(t, []).append((c, f"_s_{_alias(r)}"))
        for r in needs:
            t, c = self._owner(r)
            wanted.setdefault(t, []).append((c, c))
        for dim, cols in wanted.items():
            rel = next(x for x in self.relationships if x.fact == table and x.dim == dim)
            d = self.dims[dim].select(F.col(rel.dim_col).alias("_dk"),
                                      *[F.col(c).alias(a) for c, a in dict.fromkeys(cols)])
            how = "inner" if rel.assume_ri else "left"
            df = df.join(d, df[rel.fact_col] == d["_dk"], how).drop("_dk")
        return df.withColumnsRenamed({f"_s_{_alias(r)}": _alias(r) for r in refs
                                      if self._owner(r)[0] != table})

    def _base_names(self, names: Sequence[str]) -> list[str]:
        out: list[str] = []
        def visit(n):
            m = self.measures[n]
            if isinstance(m, Ratio):
                visit(m.num)
                visit(m.den)
            elif n not in out:
                out.append(n)
        for n in names:
            visit(n)
        return out

    # -- query ---------------------------------------------------------------
    def query(self, measures: Sequence[str], by: Sequence[str] = (), principal=None,
              order: Sequence[tuple[str, bool]] = (), limit: int | None = None) -> DataFrame:
        star = self.secured(principal)
        by = list(by)
        keys = [_alias(r) for r in by]
        groups: dict[tuple[str, tuple[str, ...]], list[Measure]] = {}
        for n in star._base_names(measures):
            m = star.measures[n]
            refs = tuple(r for r in star._reach(m.table, by) if r not in m.replaces)
            groups.setdefault((m.table, refs), []).append(m)
        full, partial = [], []
        for (table, refs), ms in groups.items():
            needs = tuple(dict.fromkeys(n for m in ms for n in m.needs))
            frame = star._frame(table, refs, needs)
            gk = [_alias(r) for r in refs]
            agg = frame.groupBy(*gk).agg(*[m.agg().alias(m.name) for m in ms])
            (full if len(refs) == len(by) else partial).append((gk, agg))
        if full:
            result = reduce(lambda a, b: _outer_on(a, b, keys), [a for _, a in full])
        else:
            dims = {star._owner(r)[0] for r in by}
            if len(dims) > 1:       # a table that all slice columns filter holds their members
                dims = {t for t, _ in groups if len(star._reach(t, by)) == len(by)}
                if not dims:
                    raise ValueError("slice columns from several unrelated dimensions")
            dim = min(dims) if dims else None
            result = (star._frame(dim, by).select(*keys).distinct() if dim
                      else star.facts[next(iter(star.facts))].sparkSession.range(1).select())
        for gk, agg in partial:
            if gk:
                result = _left_on(result, agg, gk)
            else:
                result = result.withColumns({c: agg.select(c).scalar() for c in agg.columns})
        for n in measures:
            m = star.measures[n]
            if isinstance(m, Ratio):
                r = F.try_divide(F.col(m.num).cast("double"), F.col(m.den).cast("double"))
                result = result.withColumn(n, F.round(r, m.digits) if m.digits is not None else r)
        result = result.select(*keys, *measures)
        if measures and by:
            result = result.filter(reduce(lambda a, b: a | b,
                                          [F.col(n).isNotNull() for n in measures]))
        if order:
            result = result.orderBy(*[F.col(c).desc() if desc else F.col(c).asc()
                                      for c, desc in order], *keys)
        if limit is not None:
            result = result.limit(limit)
        return result


def _alias(ref: str) -> str:
    return ref.partition(".")[2]


def _outer_on(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not keys:
        # One-row totals: attach b as a scalar subquery returning a struct.
        s = b.select(F.struct(*b.columns).alias("_b")).scalar()
        return a.select("*", s.alias("_b")).select(*a.columns, "_b.*")
    b2 = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                  *[c for c in b.columns if c not in keys])
    cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b2[f"_r_{k}"]) for k in keys])
    j = a.join(b2, cond, "full")
    return j.select(*[F.coalesce(a[k], b2[f"_r_{k}"]).alias(k) for k in keys],
                    *[c for c in a.columns if c not in keys],
                    *[c for c in b.columns if c not in keys])


def _left_on(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    b2 = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                  *[c for c in b.columns if c not in keys])
    cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b2[f"_r_{k}"]) for k in keys])
    return a.join(b2, cond, "left").drop(*[f"_r_{k}" for k in keys])
