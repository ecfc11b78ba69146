"""Writers: stage tables, quality reports, history and the message topic."""
