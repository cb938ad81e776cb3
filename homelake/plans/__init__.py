"""Table builders of each layer and the jobs that run them."""
