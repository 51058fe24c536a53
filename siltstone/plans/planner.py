"""Which row groups and files survive, which order can be reused, and which reader that makes."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from ..sources.footer import Footer, lower
from .predicates import Predicate, may_match


@dataclass(frozen=True)
class EngineConf:
    """Session switches; a strategy that is switched off is avoided where there is another."""

    use_threads: bool = True
    enable_multifile: bool = True
    enable_multifile_merge: bool = True


@dataclass
class FilePlan:
    path: str
    groups: list[int] | None  # surviving row groups, from 1; None: unknown, the file is read as it is
    skipped: list[int] = field(default_factory=list)
    rows: int = 0
    group_rows: dict[int, int] = field(default_factory=dict)


@dataclass
class ScanPlan:
    files: list[FilePlan]
    reader: str
    order: list[str]  # query keys that the files' order gives
    sort_needed: bool
    rows: int
    total_rows: int

    @property
    def paths(self) -> list[str]:
        return [f.path for f in self.files if f.groups is None or f.groups]

    def text(self) -> str:
        """The reader and, by file, its row groups."""
        out = [f"Reader: {self.reader}"]
        live = [f for f in self.files if f.groups is None or f.groups]
        if live:
            out.append("Row groups:")
            for f in live:
                listed = "all" if f.groups is None else ", ".join(map(str, f.groups))
                out.append(f"  {os.path.basename(f.path)}: {listed}" if len(live) > 1 else f"  {listed}")
        return "\n".join(out)


def prune(footers: list[tuple[str, Footer | None]], predicates: list[Predicate]) -> list[FilePlan]:
    """Row groups of each file that may hold matching rows; empty ones are never read."""
    out = []
    for path, footer in footers:
        if footer is None:
            out.append(FilePlan(path, None))
            continue
        plan = FilePlan(path, [])
        for g in footer.groups:
            if g.rows and all(may_match(g, p) for p in predicates):
                plan.groups.append(g.number)
                plan.group_rows[g.number] = g.rows
                plan.rows += g.rows
            else:
                plan.skipped.append(g.number)
        out.append(plan)
    return out


def constants(predicates: list[Predicate]) -> set[str]:
    """Columns that an equality binds to one value."""
    return {lower(p.column) for p in predicates if p.op == "="}


def needed_order(order_by: list[str], const: set[str]) -> list[str]:
    """Order keys that matter: constants and repeated keys go."""
    out: list[str] = []
    for k in order_by:
        if lower(k) not in const and lower(k) not in map(lower, out):
            out.append(k)
    return out


def usable_order(sorted_by: list[str] | tuple[str, ...], order_by: list[str], const: set[str]) -> list[str]:
    """The leading query keys that files sorted by sorted_by come in; constant columns are passed over on both sides."""
    want = needed_order(order_by, const)
    got: list[str] = []
    for k in sorted_by:
        if len(got) < len(want) and lower(want[len(got)]) == lower(k):
            got.append(want[len(got)])
        elif lower(k) not in const:
            break
    return got


def choose_reader(n: int, ordered: bool, max_open_files: int, conf: EngineConf = EngineConf()) -> str:
    """The reader's name for n files; ordered: the query wants an order that the files' own order serves."""
    if n == 0:
        return "Trivial"
    if n == 1:
        return "Single File"
    merge = "Caching Multifile Merge" if max_open_files > 0 else "Multifile Merge"
    if not ordered:
        return "Multifile" if conf.enable_multifile or not conf.enable_multifile_merge else merge
    return merge if conf.enable_multifile_merge else "Multifile"


def disjoint_in_order(footers: list[Footer | None], key: str) -> bool:
    """Whether each file's largest key is below the next file's smallest, by statistics; unknown counts as no."""
    last = None
    for f in footers:
        if f is None:
            return False
        groups = [g for g in f.groups if g.rows]
        if not groups:
            continue
        stats = [g.stats.get(lower(key)) for g in groups]
        if any(s is None or s.nulls != 0 for s in stats):
            return False
        if any(isinstance(x, (str, bytes)) for s in stats for x in (s.least, s.most)):
            return False  # texts in statistics may be cut
        low, high = min(s.least for s in stats), max(s.most for s in stats)
        if last is not None and not last < low:
            return False
        last = high
    return True
