"""Plans: configuration, transforms, whole runs and their summary."""
