"""pagefold: reconstruct, repair, align and audit page-structured text on Spark."""
