"""DataFrame operators: raw layer, staging, star schema, data-quality checks and reports."""

