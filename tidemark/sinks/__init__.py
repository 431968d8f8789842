"""Writers. All replace what was there and are written by executors."""
