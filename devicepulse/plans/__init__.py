"""The five batch jobs, composed of the operators."""
