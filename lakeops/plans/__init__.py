"""Layer pipelines: operators put together, with reading and writing at the edges."""
