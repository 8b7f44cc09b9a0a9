"""End-to-end runs: mine, analyze, predict and research."""
