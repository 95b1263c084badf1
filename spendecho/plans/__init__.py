"""Gold marts, serving views, declared checks and the end-to-end run."""
