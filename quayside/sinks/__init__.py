"""Writers: landing and secured zones, warehouse tables, audit log, state table."""
