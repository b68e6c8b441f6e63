"""End-to-end flows (model selection, scorecard chain) and the query catalog."""
