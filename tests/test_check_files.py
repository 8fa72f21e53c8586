"""Check definitions loaded from suite JSON and schema.yml documents."""

import pytest

from grievance.operators import quality as Q
from grievance.sources.checks import suite_from_json, suite_to_json, model_tests_from_yml


def test_suite_json_round_trip(tmp_path):
    p = tmp_path / "suite.json"
    p.write_text(suite_to_json(Q.RAW_SUITE))
    assert suite_from_json(str(p)) == Q.RAW_SUITE


def test_suite_rejects_unknown_type():
    with pytest.raises(ValueError):
        suite_from_json({"expectations": [{"expectation_type": "expect_magic", "kwargs": {}}]})


YAML = """
version: 2
sources:
  - name: raw
    tables:
      - name: consumer_complaints
        columns:
          - name: complaint_id
            tests: [unique, not_null]
models:
  - name: fact_complaints
    columns:
      - name: product_sk
        tests:
          - relationships:
              to: ref('dim_product')
              field: product_sk
      - name: submitted_via
        tests:
          - accepted_values:
              values: ['Web', 'Phone']
              severity: warn
"""


def test_schema_yml_tests(spark):
    pytest.importorskip("yaml")
    tests = model_tests_from_yml(YAML)
    names = [t.test_name for t in tests]
    assert names == [
        "source_unique_raw_consumer_complaints_complaint_id",
        "source_not_null_raw_consumer_complaints_complaint_id",
        "relationships_fact_complaints_product_sk",
        "accepted_values_fact_complaints_submitted_via",
    ]
    assert tests[2].to_model == "dim_product" and tests[3].severity == "warn"
    # The loaded names and semantics line up with the built-in definitions.
    builtin = {t.test_name: t for t in Q.MODEL_TESTS}
    for t in tests[:3]:
        b = builtin[t.test_name]
        assert (b.model, b.kind, b.column, b.severity, b.to_model, b.to_field) == (
            t.model, t.kind, t.column, t.severity, t.to_model, t.to_field)
    fact = spark.createDataFrame([("p1", "Web"), ("p9", "Fax")], "product_sk string, submitted_via string")
    dp = spark.createDataFrame([("p1",)], "product_sk string")
    raw = spark.createDataFrame([(1,), (1,)], "complaint_id long")
    res = {r.test_name: (r.failures, r.status) for r in Q.run_tests(
        {"consumer_complaints": raw, "fact_complaints": fact, "dim_product": dp}, tests).collect()}
    assert res == {
        "source_unique_raw_consumer_complaints_complaint_id": (1, "fail"),
        "source_not_null_raw_consumer_complaints_complaint_id": (0, "pass"),
        "relationships_fact_complaints_product_sk": (1, "fail"),
        "accepted_values_fact_complaints_submitted_via": (1, "warn"),
    }
