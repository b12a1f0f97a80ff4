"""Composite operators: vault loaders, exact median, data-quality tests."""
