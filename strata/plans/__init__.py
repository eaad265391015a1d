"""Model layers expressed as DataFrame functions: staging, intermediate, marts,
analyses, snapshots, enrichment and the declared check suite."""
