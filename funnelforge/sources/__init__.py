"""Bronze sources, sinks and TESTDATA adapters."""
