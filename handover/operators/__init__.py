"""DataFrame -> DataFrame operators: keys, validation, loads, reports, audit."""
