"""Named results and the complete job."""
