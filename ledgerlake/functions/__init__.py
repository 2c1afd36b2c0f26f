"""Column expressions: rules, risk scoring, money rounding (all JVM-side)."""
