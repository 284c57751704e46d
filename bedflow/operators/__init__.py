"""DataFrame -> DataFrame building blocks (survival curves, stay days, ranks,
FHIR shredding, profiling, classification)."""
