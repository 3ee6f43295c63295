"""Operators for preparing language-model training text, each a Spark job over whole tables.

Nothing outside this package imports it; the driver entry adds its queries only when the
package is present.
"""
