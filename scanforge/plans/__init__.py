"""Physical-plan helpers and the assembled correction plan."""
