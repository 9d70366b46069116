"""Reading, writing and schema contracts. Only this package and ``plans`` touch storage."""
