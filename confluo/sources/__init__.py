"""Reading sources into bronze rows: files, paged APIs, incremental marks."""
