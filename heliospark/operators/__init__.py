"""DataFrame-to-DataFrame operators. Frames are keyed by ``plant_id`` and local wall-clock time."""
