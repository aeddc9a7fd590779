"""Model presets and the learners MLlib does not ship."""
