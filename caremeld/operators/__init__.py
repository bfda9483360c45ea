"""Reusable DataFrame operators: concept resolution, surrogate ids, unpivots and checks."""
