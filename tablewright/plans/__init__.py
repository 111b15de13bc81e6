"""Composable relations: named tables, joins by naming convention, predicates and events."""
