"""DataFrame-in, DataFrame-out operators: graph, detectors, publish, reads, checks, evaluation."""
