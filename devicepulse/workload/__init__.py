"""The driver's tables seen as telemetry, and one registered query per operator over them."""
