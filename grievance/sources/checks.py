"""Load check definitions from the files a warehouse project already keeps.

* an expectation-suite JSON document (``{"expectations": [{"expectation_type":
  ..., "kwargs": {...}}, ...]}``) -> ``Expectation`` objects;
* a model ``schema.yml`` (``models:`` / ``sources:`` with per-column
  ``tests:``) -> ``ModelTest`` objects.

Only definitions are read here; evaluation is ``quality.run_suite`` /
``quality.run_tests``.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

from grievance.operators.quality import Expectation, ModelTest

_KIND = {
    "expect_table_row_count_to_be_between": "row_count_between",
    "expect_column_to_exist": "column_exists",
    "expect_column_values_to_not_be_null": "not_null",
    "expect_column_values_to_be_unique": "unique",
    "expect_column_values_to_be_in_set": "in_set",
    "expect_column_values_to_be_between": "between",
}


def _load(doc):
    """A document given as a path is read; text is returned as it is."""
    if isinstance(doc, Path) or (isinstance(doc, str) and "\n" not in doc and Path(doc).is_file()):
        return Path(doc).read_text(encoding="utf-8")
    return doc


def suite_from_json(doc: str | Path | dict) -> tuple[Expectation, ...]:
    """Expectations from a suite document (path, JSON text or parsed dict), in order."""
    data = doc if isinstance(doc, dict) else json.loads(_load(doc))
    out = []
    for item in data.get("expectations", []):
        etype, kw = item["expectation_type"], item.get("kwargs", {})
        if etype not in _KIND:
            raise ValueError(f"unsupported expectation type: {etype}")
        out.append(Expectation(
            _KIND[etype],
            column=kw.get("column"),
            mostly=float(kw.get("mostly", 1.0)),
            min_value=kw.get("min_value"),
            max_value=kw.get("max_value"),
            value_set=tuple(kw.get("value_set", ())),
        ))
    return tuple(out)


def suite_to_json(suite) -> str:
    """The inverse of ``suite_from_json``."""
    kinds = {v: k for k, v in _KIND.items()}
    items = []
    for e in suite:
        kw = {"column": e.column} if e.column else {}
        if e.kind not in ("row_count_between", "column_exists"):
            kw["mostly"] = e.mostly
        if e.min_value is not None:
            kw["min_value"] = e.min_value
        if e.max_value is not None:
            kw["max_value"] = e.max_value
        if e.value_set:
            kw["value_set"] = list(e.value_set)
        items.append({"expectation_type": kinds[e.kind], "kwargs": kw, "meta": {}})
    return json.dumps({"expectations": items}, indent=2)


def _ref_name(ref: str) -> str:
    m = re.match(r"""\s*ref\(\s*['"]([^'"]+)['"]\s*\)\s*$""", ref)
    return m.group(1) if m else ref


def _tests_of(model: str, column: str, specs, prefix: str = "", source_name: str | None = None) -> list[ModelTest]:
    out = []
    for spec in specs or []:
        kind, args = (spec, {}) if isinstance(spec, str) else next(iter(spec.items()))
        args = args or {}
        severity = str(args.get("severity", args.get("config", {}).get("severity", "error"))).lower()
        label = f"{source_name}_{model}" if source_name else model
        name = f"{prefix}{kind}_{label}_{column}"
        if kind in ("not_null", "unique"):
            out.append(ModelTest(model, kind, column, severity=severity, name=name))
        elif kind == "accepted_values":
            out.append(ModelTest(model, kind, column, severity=severity, values=tuple(args["values"]), name=name))
        elif kind == "relationships":
            out.append(ModelTest(model, kind, column, severity=severity, to_model=_ref_name(args["to"]),
                                 to_field=args["field"], name=name))
        else:
            raise ValueError(f"unsupported test: {kind}")
    return out


def model_tests_from_yml(doc: str | Path) -> tuple[ModelTest, ...]:
    """Generic column tests from a ``schema.yml`` / ``sources.yml`` (path or YAML text).

    Source tables keep their table name as the model name and get
    ``source_<kind>_<source>_<table>_<column>`` test names.
    """
    try:
        import yaml
    except ImportError as exc:  # optional dependency
        raise RuntimeError("reading schema.yml needs PyYAML") from exc
    data = yaml.safe_load(_load(doc)) or {}
    out: list[ModelTest] = []
    for src in data.get("sources", []) or []:
        for table in src.get("tables", []) or []:
            for col in table.get("columns", []) or []:
                out += _tests_of(table["name"], col["name"], col.get("tests"), "source_", src["name"])
    for model in data.get("models", []) or []:
        for col in model.get("columns", []) or []:
            out += _tests_of(model["name"], col["name"], col.get("tests"))
    return tuple(out)
