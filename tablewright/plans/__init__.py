"""Declarative table plans: conform specs, the domain's tables, the target model, whole runs."""
