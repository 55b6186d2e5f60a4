"""Writers: tables, history, CSV exports, reports, statistics."""
