"""Reports and workloads composed of several operators."""
