"""Named reports, one module per subject."""
