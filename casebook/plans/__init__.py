"""The job catalogue: one module per family, the registry and the oracle SQL."""
