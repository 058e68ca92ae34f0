"""Silver entities, gold dimensions and facts, marts, metrics and documented requirements."""
