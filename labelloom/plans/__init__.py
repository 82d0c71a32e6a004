"""End-to-end jobs whose steps are tables in one folder."""
