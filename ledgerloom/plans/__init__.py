"""The reports: each one a public function over a set of tables."""
