"""DataFrame → DataFrame operators: merges (SCD2, SCD1), DML emulation,
surrogate keys, projections, hierarchy flattening, star lookups, checks."""
