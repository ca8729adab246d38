"""Writers: tables, files, versioned snapshots and relational copies."""
