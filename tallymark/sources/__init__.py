"""Reading updates, samples and snapshots; writing snapshots and payloads."""
