"""Plan-level helpers (checked broadcasts, lineage cuts) and multi-step jobs."""
