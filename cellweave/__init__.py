"""Spark jobs for barcoded sequencing reads: extraction, UMI correction and count matrices."""
