"""Writers of tables, progress marks and the database copy."""
