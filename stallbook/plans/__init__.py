"""Physical building blocks and whole-job plans."""
