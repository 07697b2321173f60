"""Prompts of several families as expressions over a question and its contexts; a query's type picks a row of a table of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvidex.functions.questions import lines, max_choice

# System text, and instructions by question type
BASE = "당신은 한국 금융 보안 분야의 전문가입니다.\n다음 원칙을 따라 답변하세요:\n1. 정확성: 제공된 문서의 내용을 정확히 인용\n2. 전문성: 금융 용어와 개념을 정확히 사용\n3. 명확성: 구조화된 답변으로 이해하기 쉽게 설명\n4. 규제 준수: 한국 금융 규제 및 가이드라인 준수"
INSTRUCTIONS = {
    "definition": "\n제공된 문서를 바탕으로 다음 개념을 명확히 정의하고 설명하세요:\n- 정의: 핵심 개념을 간단명료하게\n- 특징: 주요 특징과 구성 요소\n- 예시: 실제 적용 사례 (있다면)\n",
    "procedure": "\n제공된 문서를 바탕으로 다음 절차를 단계별로 설명하세요:\n1. 각 단계를 번호로 구분\n2. 구체적인 실행 방법 포함\n3. 주의사항이나 팁 추가\n",
    "comparison": "\n제공된 문서를 바탕으로 비교 분석하세요:\n- 공통점: 유사한 특징들\n- 차이점: 구별되는 특징들\n- 장단점: 각각의 강점과 약점\n- 권장사항: 상황별 적합한 선택\n",
    "analysis": "\n제공된 문서를 바탕으로 심층 분석하세요:\n- 현황: 현재 상태와 문제점\n- 원인: 근본 원인 분석\n- 영향: 예상되는 영향과 리스크\n- 해결책: 구체적인 개선 방안\n",
    "compliance": "\n제공된 문서와 관련 규제를 바탕으로 답변하세요:\n- 관련 규제: 적용되는 법규와 가이드라인\n- 요구사항: 충족해야 할 구체적 요건\n- 준수 방법: 실제 구현 방안\n- 벌칙/리스크: 미준수 시 결과\n",
    "security": "\n제공된 문서를 바탕으로 보안 관점에서 답변하세요:\n- 위협 요소: 잠재적 보안 위험\n- 취약점: 시스템의 약점\n- 대응 방안: 구체적인 보안 조치\n- 모범 사례: 업계 베스트 프랙티스\n",
}
OTHER_INSTRUCTION = "제공된 문서를 바탕으로 정확하고 상세하게 답변하세요."
CITE = "\n\n답변 시 관련 문서 번호를 [문서 N] 형식으로 인용하세요."
# The frames of each family
STEPS = "답변 과정:\n1. 질문 분석: 질문의 핵심 요구사항 파악\n2. 정보 추출: 문서에서 관련 정보 식별\n3. 논리 전개: 추출된 정보를 바탕으로 논리적 연결\n4. 결론 도출: 최종 답변 정리\n\n단계별 추론:\n"
STEPS_SYSTEM = "\n\n단계별로 명확하게 추론 과정을 보여주세요."
SUBJECTS = {"definition": "핵심 개념이나 용어의 정의", "process": "절차, 프로세스, 방법론", "regulation": "법률, 규정, 기준", "example": "구체적 사례나 실제 적용", "comparison": "차이점이나 비교", "application": "활용 방법이나 대응 방안"}
SAMPLES = {
    "definition": "개인정보 보호위원회란 어떤 기구이며 주요 역할은 무엇인지 간략하게 설명하시오?",
    "process": "금융회사들이 오픈소스 소프트웨어를 활용하면서 라이선스 문제를 해결하기 위해 어떤 단계들을 거쳐야 하나요?",
    "regulation": "긴급 상황에서 개인 정보를 제한 없이 사용할 수 있는 조건과 그 내용을 설명하여라?",
    "example": "특정 고객의 거래 내역을 분석하는 과정에서 발생 가능한 개인정보 유출 위험이 어떤 것들이 있을까요?",
    "comparison": "TDES와 AES 암호화 알고리즘의 보안성과 성능 측면에서 어떤 차이가 있는지 설명하시오?",
    "application": "위치정보 이용에 따른 개인정보 노출 위험성을 어떻게 관리해야 하는지 설명하십시오?",
}
MAKE_RULES = "<규칙>\n- 반드시 한글로만 작성\n- 질문 하나만 작성 (번호 없이)\n- 완전한 한 문장으로 작성\n- 물음표로 끝내기\n- 구체적이고 명확한 질문\n- 메타 텍스트나 참조 표현 금지"
STRICT_SYSTEM = "당신은 한국 금융보안 분야의 전문가입니다. 한국어로만 답변하세요."
STRICT_MC = (
    "[중요 지침 - 엄격히 준수]\n• 참고 문서와 전문지식을 종합하여 가장 정확한 답을 선택하세요\n• 반드시 1~",
    ' 범위의 단일 숫자만 출력하세요\n• 설명, 이유, 추가 텍스트는 절대 포함하지 마세요\n• 숫자 앞이나 뒤에 어떤 텍스트도 추가하지 마세요\n• 쉼표, 마침표, 콜론 등 어떤 기호도 포함하지 마세요\n• "답변:", "정답:", "선택:" 등의 표현을 사용하지 마세요\n• 오직 숫자 하나만 출력하세요 (예: 3)\n• 여러 숫자나 범위를 절대 출력하지 마세요\n• 한국어 설명을 절대 포함하지 마세요\n• 숫자만 출력하세요 - 다른 모든 내용 금지\n\n[질문]\n',
    "\n\n위 객관식 문제의 정답 번호 하나만 출력하세요. 설명 없이 숫자만 출력하세요.\n\n정답:",
)
STRICT_OPEN = (
    '[중요 지침]\n• 참고 문서와 전문지식을 종합하여 명확한 답변을 제시하세요.\n• 질문의 핵심 요구사항을 모두 답하되, 간결한 답변을 생성하세요.\n• 중간 사고 과정이나 참고 문서 내용은 절대 답변에 포함하지 마세요.\n• 20자 이상 500자 이하로 작성하세요\n• "모른다", "답변을 생성할 수 없습니다", "정보가 부족합니다" 등의 표현을 절대 사용하지 마세요\n• 기본 지식과 일반적인 보안 원칙을 활용해 반드시 구체적인 답변을 제공하세요\n• 금융보안 분야의 전문가로서 확신 있고 유용한 정보를 반드시 제공하세요\n• 완전한 한국어 문장으로만 답변하세요\n• 질문에 대한 답변을 반드시 작성해야 합니다 - 예외는 없습니다\n\n[질문]\n',
    "\n\n위 질문에 대해 금융보안 전문가로서 반드시 구체적이고 유용한 답변을 작성하세요. 답변 거부나 생성 실패는 허용되지 않습니다.\n\n답변:",
)
TEACH_MC = "당신은 한국 금융보안 전문가입니다. 참고 문서를 깊이 이해하고 정확한 답변을 제공하세요."
TEACH_OPEN = "당신은 한국 금융보안 전문가입니다. 참고 문서를 바탕으로 핵심만 간결하게 답변하세요."


def pick(kind: Column, table: dict[str, str], default: str) -> Column:
    """The text of a type; the table is a literal, so nothing is joined."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for row in table.items() for x in row]), kind), F.lit(default))


def numbered(contexts: Column) -> Column:
    return F.array_join(F.transform(contexts, lambda c, i: F.concat(F.lit("[문서 "), (i + 1).cast("string"), F.lit("]\n"), c)), "\n\n")


def _both(system: Column, user: Column) -> Column:
    return F.struct(system.alias("system"), user.alias("user"))


def typed(question: Column, contexts: Column, kind: Column, citations: bool = True) -> Column:
    """(system, user): all contexts, the instruction of the question's type, and whether to cite."""
    user = F.concat(F.lit("참고 문서:\n"), numbered(contexts), F.lit("\n\n"), pick(kind, INSTRUCTIONS, OTHER_INSTRUCTION), F.lit("\n\n질문: "), question, F.lit(f"\n{CITE if citations else ''}\n\n답변:"))
    return _both(F.lit(BASE), user)


def step_by_step(question: Column, contexts: Column) -> Column:
    """(system, user) that ask for reasoning in steps."""
    user = F.concat(F.lit("참고 문서:\n"), numbered(contexts), F.lit("\n\n다음 질문에 대해 단계별로 추론하여 답변하세요:\n\n질문: "), question, F.lit("\n\n" + STEPS))
    return _both(F.lit(BASE + STEPS_SYSTEM), user)


def few_shot(prompt: Column, examples: Column) -> Column:
    """Numbered ``struct<question, answer>`` examples before a prompt."""
    each = F.transform(examples, lambda e, i: F.concat(F.lit("예시 "), (i + 1).cast("string"), F.lit(":\n질문: "), e["question"], F.lit("\n답변: "), e["answer"], F.lit("\n\n")))
    return F.concat(F.lit("다음은 좋은 답변의 예시입니다:\n\n"), F.array_join(each, ""), F.lit("\n"), prompt)


def make_question(chunk: Column, kind: Column) -> Column:
    """Asks for one question of a type about the first 1000 characters of a chunk."""
    return F.concat(
        F.lit("<지침>\n당신은 한국 금융보안원 시험 출제위원입니다. 다음 내용을 바탕으로 "),
        pick(kind, SUBJECTS, "일반"),
        F.lit("에 관한 질문을 하나만 작성하세요.\n\n<좋은 질문 예시>\n"),
        pick(kind, SAMPLES, SAMPLES["definition"]),
        F.lit(f"\n\n{MAKE_RULES}\n\n<참고 내용>\n"),
        F.left(chunk, F.lit(1000)),
        F.lit("\n\n질문:"),
    )


def _first_three(contexts: Column) -> Column:
    return F.when(F.size(contexts) > 0, F.concat(F.lit("[참고 문서]\n"), F.array_join(F.slice(contexts, 1, 3), "\n\n"), F.lit("\n\n"))).otherwise("")


def strict(question: Column, contexts: Column, is_mc: Column) -> Column:
    """One text with chat marks: three whole contexts and orders that leave no room for more than the answer."""
    mc = F.concat(F.lit(STRICT_MC[0]), max_choice(question).cast("string"), F.lit(STRICT_MC[1]), question, F.lit(STRICT_MC[2]))
    free = F.concat(F.lit(STRICT_OPEN[0]), question, F.lit(STRICT_OPEN[1]))
    return F.concat(F.lit(f"<|im_start|>system\n{STRICT_SYSTEM}<|im_end|>\n<|im_start|>user\n"), _first_three(contexts), F.when(is_mc, mc).otherwise(free), F.lit("<|im_end|>\n<|im_start|>assistant"))


def plain(question: Column, contexts: Column) -> Column:
    """Three whole contexts and the question; any line that looks like a choice makes it multiple choice."""
    from corvidex.functions.questions import MC_SECOND

    is_mc = F.exists(lines(question), lambda x: x.rlike(MC_SECOND))
    return F.concat(_first_three(contexts), F.lit("[질문]\n"), question, F.when(is_mc, "\n\n정답 번호만 출력하세요.").otherwise("\n\n간결하고 명확한 답변을 작성하세요."))


def teacher(question: Column, contexts: Column, is_mc: Column, length: int = 600) -> Column:
    """(system, user) with the first ``length`` characters of every context that is not empty; numbers count the empty ones."""
    from corvidex.functions.questions import DIGIT

    docs = F.array_join(F.filter(F.transform(contexts, lambda c, i: F.when(c != "", F.concat(F.lit("[참고문서 "), (i + 1).cast("string"), F.lit("]\n"), F.left(c, F.lit(length)), F.lit("\n\n")))), lambda x: x.isNotNull()), "")
    parts = lines(question)
    choices = F.array_join(F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1))), lambda x: x.rlike("^" + DIGIT)), "\n")
    head = F.get(F.split(question, "\n"), F.lit(0))
    mc = F.concat(F.lit("참고 문서:\n"), docs, F.lit("\n\n문제: "), head, F.lit("\n\n선택지:\n"), choices, F.lit("\n\n지침: 참고 문서를 바탕으로 가장 정확한 답을 선택하세요. 답변은 숫자만 출력하세요.\n\n정답:"))
    free = F.concat(F.lit("참고 문서:\n"), docs, F.lit("\n\n질문: "), question, F.lit("\n\n지침: \n- 참고 문서의 핵심 내용만 추출하여 답변하세요\n- 2-3문장으로 간결하게 요약하세요\n- 불필요한 설명은 제외하세요\n- 정확한 사실만 포함하세요\n\n답변:"))
    return F.when(is_mc, _both(F.lit(TEACH_MC), mc)).otherwise(_both(F.lit(TEACH_OPEN), free))
