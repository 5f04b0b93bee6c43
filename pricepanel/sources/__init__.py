"""Sources and sinks: archives (S1-S3), API pages (S4), fact store (S5, S6),
CSV export and JSON reports (S7, S8)."""
