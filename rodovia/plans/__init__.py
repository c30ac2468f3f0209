"""Declarative plans: conformance, star schema, views, reports and audits."""
