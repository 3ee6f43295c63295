"""Column expressions: text, numbers/grades/codes, dates/terms."""

from .dates import (contradicts, date_text, incorrect_term, outside_test_window, parse_partner_date, plausible_dob, study_year,
                    term_reading, term_year, test_date_out_of_range, yyyymm_number)
from .numbers import (clean_grade, clean_int, ethnic_code, gender_fix, parse_grade_list, pct,
                      scale_code, sentinel_to_null, sex_code, simple_grade_list, subject_name, try_number,
                      vendor_grade)
from .text import (agency_code, agency_code_legacy, blank_to_null, file_name_of, grade_text_norm,
                   id_key, is_edited_file, is_nonblank, list_to_text, name_key, normalize_strings,
                   null_tokens_to_null, rename_with_prefix, sanitize_columns, strip, strip_edited_prefix,
                   timestamped_name, upper_trim)

__all__ = [n for n in dir() if not n.startswith("_")]
