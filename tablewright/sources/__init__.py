"""Reading pages, tables, catalogs and files; writing artifacts."""
