"""Report operators: pure ``DataFrame -> DataFrame`` functions, lazy until a sink acts."""
