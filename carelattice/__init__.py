"""Clinical data on Spark: raw HL7, FHIR and CSV to identity-resolved, coded tables and analytics, as lazy DataFrames."""
