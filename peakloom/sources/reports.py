"""Reports for people: small frames as JSON, CSV and Markdown. A frame of more rows than a page holds is refused."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from . import files

PAGE = 10_000  # rows of a report at most; reports are of groups, columns and checks


def _rows(df: DataFrame) -> list[dict]:
    out = [r.asDict(recursive=True) for r in df.limit(PAGE + 1).collect()]
    if len(out) > PAGE:
        raise ValueError(f"more than {PAGE} rows are no report")
    return out


def write_diagnostics(per_group: DataFrame, stem: str, params: dict, dropped: dict[str, int] | None = None, group: str = "grp") -> dict:
    """{stem}.json and {stem}.csv of a diagnostics frame, one row a group, with what it was made with; the JSON's content.

    Files of that name must not be there.
    """
    spark, rows = per_group.sparkSession, sorted(_rows(per_group), key=lambda r: str(r[group]))
    payload = {"params": params, "n_metacells_total": sum(r.get("n_metacells") or 0 for r in rows), "groups_used": [r[group] for r in rows], "groups_dropped": dropped or {}, "per_group": {str(r[group]): {k: v for k, v in r.items() if k != group} for r in rows}}
    files.write_new(spark, f"{stem}.json", json.dumps(payload, indent=2, default=str))
    quote = lambda x: "" if x is None else f'"{x}"'.replace('""', '"') if "," in str(x) else str(x)
    names = per_group.columns
    files.write_new(spark, f"{stem}.csv", "\n".join([",".join(names), *(",".join(quote(r[c]) for c in names) for r in rows)]) + "\n")
    return payload


def markdown(title: str, sections: dict[str, DataFrame]) -> str:
    """A page with a table for each section; bars in cells are escaped, a section without rows says so."""
    cell = lambda x: "" if x is None else (f"{x:.4g}" if isinstance(x, float) else str(x)).replace("|", "\\|").replace("\n", " ")
    out = [f"# {title}", ""]
    for name, df in sections.items():
        rows = _rows(df)
        out += [f"## {name}", ""]
        if rows:
            out += ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(cell(r[c]) for c in df.columns) + " |" for r in rows), ""]
        else:
            out += ["nothing to report", ""]
    return "\n".join(out)


def write_profile(spark: SparkSession, stem: str, title: str, sections: dict[str, DataFrame]) -> None:
    """{stem}.md and {stem}.json of a profile's frames (shapes, columns, modalities, checks)."""
    files.write_new(spark, f"{stem}.md", markdown(title, sections))
    files.write_new(spark, f"{stem}.json", json.dumps({name: _rows(df) for name, df in sections.items()}, indent=2, default=str))
