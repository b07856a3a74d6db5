"""End-to-end plans: feature tables, the star join, the modelling table and
the catalogue of registered queries."""
