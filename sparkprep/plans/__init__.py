"""Query registry, flagship pipeline and oracle SQL generators."""
